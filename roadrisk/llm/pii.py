"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

Each value is validated (Luhn check digit, IBAN remainder, real calendar day, octets,
area numbers), brought to a canonical form and permuted within the set of values of its
format by a keyed Feistel network with cycle walking: a card number becomes another
number with a right check digit, a date another day of the calendar, and separators stay
where they were. The permutation depends on the key and the kind only, so equal values
stay linked across documents, whatever their separators, and whoever holds the key can
turn them back (``reveal``).

Letters and digits of any script are permuted among those of their own kind (in names of
e-mail addresses, say). A value that has nothing to permute stays and isn't reported.
Long numbers without a right check digit are permuted as plain digits. Overlapping
candidates go to the first kind listed that holds at their start; where none does, the
search goes on from the next character. An IBAN may end before its candidate does (the
country's length first, then shorter endings, longest first). A date that is right month
first only is a kind of its own, permuted among such dates.

Defined cases: a null text stays null, an empty one empty; an invalid date, IBAN or
address is left alone; repeated values and rows get equal pseudonyms; an empty table
gives no rows; other columns pass
through (a ``pii`` of the input is replaced).
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import ipaddress
import math
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROUNDS = 10
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1), 73049  # to 2099-12-31
#: Days after the 12th, which can't be taken for a month.
_LATE_DAYS = [n for n in range(_DAYS) if (_FIRST_DAY + datetime.timedelta(days=n)).day > 12]
_IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 "
    "LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 "
    "SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_RANGES = [("a", "z"), ("A", "Z"), ("0", "9"), ("à", "ö"), ("ø", "ÿ"), ("À", "Ö"), ("Ø", "Þ")]
_ALPHABETS = ["".join(map(chr, range(ord(a), ord(z) + 1))) for a, z in _RANGES]
_ALPHABET_OF = {c: a for a in _ALPHABETS for c in a}
_HEX_OF = {c: a for a in ("0123456789", "abcdef", "ABCDEF") for c in a}


@functools.lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """The letters or digits that ``c`` is permuted among: its alphabet, for other scripts the
    characters of its general category in its block of 256; nothing for other characters."""
    if c in _ALPHABET_OF or not c.isalnum():
        return _ALPHABET_OF.get(c, "")
    first, kind = ord(c) & ~0xFF, unicodedata.category(c)
    return "".join(x for x in map(chr, range(first, first + 256)) if unicodedata.category(x) == kind and x not in _ALPHABET_OF)


class Permuter:
    """A keyed permutation of range(n) for any n, by kind."""

    def __init__(self, key: bytes):
        self._key = hashlib.sha256(key).digest()

    def _f(self, kind: str, n: int, turn: int, half: int) -> int:
        data = f"{kind}|{n}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self._key, digest_size=32).digest(), "big")

    def _network(self, kind: str, n: int, x: int, back: bool) -> int:
        """One pass over range(a * b) >= range(n): the halves add to each other in turn."""
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        left, right = divmod(x, b)
        for turn in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                right = (right + sign * self._f(kind, n, turn, left)) % b
            else:
                left = (left + sign * self._f(kind, n, turn, right)) % a
        return left * b + right

    def permute(self, kind: str, n: int, x: int, back: bool = False) -> int:
        if n < 2:
            return x
        x = self._network(kind, n, x, back)
        while x >= n:  # cycle walking: stay within the format
            x = self._network(kind, n, x, back)
        return x

    def digits(self, kind: str, s: str, back: bool = False) -> str:
        return str(self.permute(f"{kind}{len(s)}", 10 ** len(s), int(s), back)).zfill(len(s))

    def characters(self, kind: str, s: str, back: bool = False, alphabet_of=_alphabet) -> str:
        """Each letter and digit within its own alphabet, other characters as they are."""
        at = [(i, a) for i, c in enumerate(s) if (a := alphabet_of(c))]
        n = x = 0
        shape = ""
        for k, (i, alphabet) in enumerate(at):
            n, x = (n or 1) * len(alphabet), x * len(alphabet) + alphabet.index(s[i])
            shape += alphabet[0]
        x = self.permute(kind + shape, n, x, back) if n else 0
        out = list(s)
        for i, alphabet in reversed(at):
            x, r = divmod(x, len(alphabet))
            out[i] = alphabet[r]
        return "".join(out)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _fill(shape: str, chars: str) -> str:
    """Put ``chars`` where ``shape`` has letters or digits."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _email(p: Permuter, s: str, back: bool) -> str:
    local, _, domain = s.rpartition("@")
    return p.characters("email@" + domain.lower(), local, back) + "@" + domain


def _ipv4(p: Permuter, s: str, back: bool) -> str | None:
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    v = p.permute("ipv4", 1 << 32, int.from_bytes(bytes(octets), "big"), back)
    return ".".join(map(str, v.to_bytes(4, "big")))


def _ipv6(p: Permuter, s: str, back: bool) -> str | None:
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return None
    return p.characters("ipv6", s, back, lambda c: _HEX_OF.get(c, ""))


def _iban_ends(s: str) -> list[int]:
    """Where an IBAN that begins the candidate may end: at its country's length, or before
    a character that doesn't continue its last token (lower-case ones: their length only)."""
    size = _IBAN_LENGTH.get(s[:2].upper())
    if s[:2].islower():
        return [size] if size == len(s) else []
    at = [i + 1 for i, c in enumerate(s) if c != " "]
    fixed = at[size - 1:size] if size else []
    return fixed + [i for i in reversed(at) if (i == len(s) or s[i] == " ") and i not in fixed]


def _iban(p: Permuter, s: str, back: bool) -> str | None:
    flat = s.replace(" ", "").upper()
    country, check, rest = flat[:2], flat[2:4], flat[4:]
    if not 15 <= len(flat) <= 34 or _iban_check(country, rest) != check:
        return None
    rest = p.characters("iban" + country, rest, back)
    new = _fill(s, country + _iban_check(country, rest) + rest)
    return new.lower() if s[:2].islower() else new


def _day(year: str, month: str, day: str) -> int | None:
    try:
        n = (datetime.date(int(year), int(month), int(day)) - _FIRST_DAY).days
    except ValueError:
        return None
    return n if 0 <= n < _DAYS else None


def _date(p: Permuter, s: str, back: bool) -> str | None:
    year_first = s[4:5] in "./-"
    y, m, d = re.split(r"[./-]", s) if year_first else reversed(re.split(r"[./-]", s))
    n = _day(y, m, d)
    if n is None:
        return None
    new = _FIRST_DAY + datetime.timedelta(days=p.permute("date", _DAYS, n, back))
    if year_first:
        return f"{new.year}{s[4]}{new.month:02d}{s[4]}{new.day:02d}"
    return f"{new.day:02d}{s[-5]}{new.month:02d}{s[-5]}{new.year}"


def _date_short(p: Permuter, s: str, back: bool) -> str | None:
    """Day first with two digits for the year: a day of 1950 to 2049."""
    d, m, y = re.split(r"[./-]", s)
    n = _day(f"{'19' if y >= '50' else '20'}{y}", m, d)
    if n is None:
        return None
    first = (datetime.date(1950, 1, 1) - _FIRST_DAY).days
    new = datetime.date(1950, 1, 1) + datetime.timedelta(days=p.permute("date_short", 36525, n - first, back))
    return f"{new.day:02d}{s[2]}{new.month:02d}{s[2]}{new.year % 100:02d}"


def _month_first(p: Permuter, s: str, back: bool) -> str | None:
    m, d, y = re.split(r"[./-]", s)
    n = _day(y, m, d)
    if n is None or int(d) <= 12:  # else it is right day first, too
        return None
    new = _FIRST_DAY + datetime.timedelta(days=_LATE_DAYS[p.permute("date_month_first", len(_LATE_DAYS), bisect.bisect(_LATE_DAYS, n) - 1, back)])
    return f"{new.month:02d}{s[2]}{new.day:02d}{s[2]}{new.year}"


def _ssn(p: Permuter, s: str, back: bool) -> str | None:
    def known(x: str) -> bool:
        return x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"
    x = s.replace("-", "")
    if not known(x):
        return None
    while True:  # walk on to the next number that could be issued
        x = p.digits("ssn", x, back)
        if known(x):
            return _fill(s, x)


def _number(p: Permuter, s: str, back: bool) -> str:
    x = re.sub(r"\D", "", s)
    if luhn_digit(x[:-1]) == x[-1]:
        body = p.digits("card", x[:-1], back)
        return _fill(s, body + luhn_digit(body))
    while True:  # a number that isn't a card's stays one
        x = p.digits("number", x, back)
        if luhn_digit(x[:-1]) != x[-1]:
            return _fill(s, x)


def _phone(p: Permuter, s: str, back: bool) -> str | None:
    country, rest = re.fullmatch(r"(\+\d{1,3}[ .-]?)?(.*)", s).groups()
    digits = re.sub(r"\D", "", rest)
    if not 6 <= len(digits) <= 14:
        return None
    return (country or "") + _fill(rest, p.digits("phone", digits, back))


#: kind -> (pattern, permutation), tried in this order.
KINDS = {
    "email": (r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+", _email),
    "iban": (r"\b(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}\d{2}[a-z0-9]{11,30})\b", _iban),
    "ipv6": (r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])", _ipv6),
    "ipv4": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ipv4),
    "date": (r"(?<![\d./-])(?:\d{4}(?P<sep3>[./-])\d{2}(?P=sep3)\d{2}|\d{2}(?P<sep>[./-])\d{2}(?P=sep)\d{4})(?![\d/-])", _date),
    "date_month_first": (r"(?<![\d./-])\d{2}(?P<sep2>[./-])\d{2}(?P=sep2)\d{4}(?![\d/-])", _month_first),
    "date_short": (r"(?<![\d./-])\d{2}(?P<sep4>[./-])\d{2}(?P=sep4)\d{2}(?![\d/-]|\.\d)", _date_short),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "number": (r"(?<!\d)(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)", _number),
    "phone": (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{4}(?!\d)"
              r"|(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\d{1,4}){2,6}|0\d{1,4}/\d{4,8})(?![\d/])", _phone),
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))
_EACH = {k: re.compile(p) for k, (p, _) in KINDS.items()}


def _without_context(pattern: str) -> str:
    """The pattern for Arrow's matcher, which has no context or back-references: it matches
    wherever the pattern does."""
    pattern = re.sub(r"\(\?<?!(?:\[[^]]*\]|[^()\[\]])*\)|\\b", "", pattern)
    pattern = re.sub(r"\(\?P<sep\d?>(.*?)\)", r"\1", pattern)
    pattern = re.sub(r"\(\?P=sep\d?\)", "[./-]", pattern)
    return pattern.replace(r"\d", r"\p{Nd}").replace(r"\w", r"\pL\pN_")


#: Texts that a kind could match: derived, so that no kind is forgotten.
_MAYBE = "|".join(f"(?:{_without_context(p)})" for p, _ in KINDS.values())


def _value(text: str, m: re.Match, permuter: Permuter, back: bool) -> tuple[str, int, str] | None:
    """(kind, end, new value) of the first kind that holds where ``m`` starts."""
    kinds = list(KINDS)
    for kind in kinds[next(i for i, k in enumerate(kinds) if m[k] is not None):]:
        if c := _EACH[kind].match(text, m.start()):
            for size in _iban_ends(c[0]) if kind == "iban" else [len(c[0])]:
                new = KINDS[kind][1](permuter, c[0][:size], back)
                if new is not None:
                    return kind, m.start() + size, new
    return None


def replace(text: str, permuter: Permuter, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with every value permuted, and (kind, start, end) of each in the new text."""
    out, spans, at, size, look = [], [], 0, 0, 0
    while m := _ANY.search(text, look):
        found = _value(text, m, permuter, back)
        if found is None:
            look = m.start() + 1
            continue
        kind, look, new = found
        out += [text[at:m.start()], new]
        size += m.start() - at
        if new != text[m.start():look]:
            spans.append((kind, size, size + len(new)))
        size += len(new)
        at = look
    out.append(text[at:])
    return "".join(out), spans


def pseudonymise(docs: DataFrame, key: bytes, *, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with values replaced in the text, and ``pii``: kind and place of each."""
    docs = docs.drop("pii")
    schema = T.StructType([*docs.schema.fields, T.StructField("pii", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    place = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        p = Permuter(key)
        for b in batches:
            col = b.column(place)
            maybe = pc.fill_null(pc.match_substring_regex(col, _MAYBE), False).to_pylist()
            if any(maybe):
                found = [replace(col[i].as_py(), p, back) if x else None for i, x in enumerate(maybe)]
                new = pa.array([f[0] if f else None for f in found], col.type)
                col = pc.if_else(pa.array(maybe), new, col)
                spans = [[dict(zip(("kind", "start", "end"), s)) for s in f[1]] if f else [] for f in found]
            else:
                spans = [[]] * b.num_rows
            cols = list(b.columns)
            cols[place] = col
            yield pa.record_batch([*cols, pa.array(spans, kind)], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def reveal(docs: DataFrame, key: bytes, *, text_col: str = "text") -> DataFrame:
    """The inverse of ``pseudonymise`` for the holder of the key."""
    return pseudonymise(docs, key, text_col=text_col, back=True)
