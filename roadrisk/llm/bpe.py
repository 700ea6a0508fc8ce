"""Token ids of whole texts by a public tokenizer file, with a bounded cache of text pieces.

A BPE tokenizer never merges over a change from non-space to white space, so a text cut
there and encoded piece by piece gives the ids of the whole text. Running text repeats
its pieces, so a column of texts is cut in Arrow and dictionary-encoded, each piece's ids
are looked up once, and the texts' ids are gathered from them. A worker keeps the ids of
pieces (as little-endian 32-bit integers) in a cache of two generations of bounded size.

A plain piece (a space or line break, Latin letters, closing punctuation) is handed to
the tokenizer's BPE model word by word, which skips most of the library's cost per call;
any other piece goes through its whole pipeline. Where words can be encoded in bulk, a
column's different plain pieces are trimmed and encoded as columns, without a Python object
or cache entry a piece: lower-cased where words lose their space and case, with the space or
line break before them where they keep it. Which white space and case the model
gets is found by probing the pipeline, and the short way is off if the probes differ.

Words are encoded in bulk by tiktoken, from the same file's entries: space-led words of
a byte-level BPE as they are, words of a BPE with word ends as one ASCII character a symbol
(the lower-case Latin letters have few enough, with and without a word end). Its merges go by
the rank of the joined symbols, the file's by the rank of the pair. Both give the same ids if
the entries' ids are in the order of their merges and every entry, encoded alone, is one
token: the parts of a span whose ends still stand have been merged as if the span stood
alone, so the last two parts of an entry are always its own pair. Both conditions are tested
when a file is loaded; bulk encoding is off otherwise.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadrisk.llm.text import chunks

#: White space of the tokenizers (Unicode's property; Python's \\s has four control characters more).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_DOUBLE = re.compile(f"[{_SPACE}][{_SPACE}]")
_PLAIN = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")
#: The same over pieces that are joined by the cut mark; other pieces give an empty word.
_PLAINS = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]{1,50})([.,!?;:]{0,10})\x01|[^\x01]*\x01")
_CUT = "\x01"
#: Texts that Arrow can't cut: they hold the mark, or a cut that would follow white space.
_ODD = r"\x01|[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][ \n]"
#: ``_PLAINS`` for one piece, the same with a space or line break before it (words that keep
#: them are told apart by them), and the word of such a piece.
_PLAIN_PIECE = r"^[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]{1,50}[.,!?;:]{0,10}\z"
_LED_PIECE = r"^[ \n][A-Za-zÀ-ÖØ-öø-ÿ]{1,50}[.,!?;:]{0,10}\z"
_WORD = r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+"
_CHUNK = 2 << 20
#: Where different pieces are encoded in bulk: the more text, the fewer of them, and the
#: pieces kept are only those that aren't plain.
_BULK_CHUNK = 4 << 20
_BULK_CACHE = 50_000
_PROBES = [" Probe.", "\nÉtude,", "Straße!?", " a", "Ñandú", " ÀÖØÞ;:", "word", "\nUnd."]


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE's rule: printable bytes stand for themselves, the others follow
    from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``encode(texts)`` gives each text's ids as bytes (4 per id)."""

    def __init__(self, path: str, cache: int = 300_000, max_piece: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._model = self._tok.model
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._limit, self._max_piece = cache, max_piece
        chars = _byte_chars()
        self._map = {c: "".join(chars[b] for b in chr(c).encode()) for c in range(256)}
        self._keep_space = self._lower = False
        self._plain = any(self._probe(k, low) for k in (True, False) for low in (False, True))
        self._bulk, self._lengths, self._inner, self._final = None, None, None, None
        if self._plain and self._keep_space != self._lower:  # spaces and case kept, or neither
            self._load_bulk(path, chars)

    def _load_bulk(self, path: str, chars: dict[int, str]) -> None:
        """tiktoken's encoding of the file's entries, and the entries' lengths in symbols."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        base = len(chars) * (2 if suffix else 1)
        single = set(chars.values()) | ({c + suffix for c in chars.values()} if suffix else set())
        if {e for e, i in vocab.items() if i < base} != single or any(vocab.get(a + b) != base + i for i, (a, b) in enumerate(pairs)):
            return
        if not suffix and self._keep_space:
            code, pattern = {c: bytes([b]) for b, c in chars.items()}, r"\n| ?[A-Za-zÀ-ÖØ-öø-ÿ]+"
        elif suffix and self._lower:
            letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if c != 0xF7]
            inner = sorted({b for x in letters for b in x.encode()})
            final = sorted({x.encode()[-1] for x in letters})
            code = {chars[b]: bytes([1 + k]) for k, b in enumerate(inner)}
            code |= {chars[b] + suffix: bytes([1 + len(inner) + k]) for k, b in enumerate(final)}
            spell = lambda x, end: "".join(code[chars[b] + e].decode() for b, e in zip(x.encode(), [""] * (len(x.encode()) - 1) + [end]))
            self._inner, self._final = {ord(x): spell(x, "") for x in letters}, {x: spell(x, suffix) for x in letters}
            self._inner_bytes, self._final_bytes = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
            for k, b in enumerate(inner):
                self._inner_bytes[b] = 1 + k
            for k, b in enumerate(final):
                self._final_bytes[b] = 1 + len(inner) + k
            pattern = rf"[\x01-\x{len(inner):02x}]*[\x{len(inner) + 1:02x}-\x{len(code):02x}]"
        else:
            return
        spelt = {}  # the entries that these symbols can spell, and how
        for e, i in vocab.items():
            if i < base + len(pairs):
                ended = suffix and e.endswith(suffix)
                symbols = [*e[:-len(suffix) - 1], e[-len(suffix) - 1] + suffix] if ended else e
                if all(x in code for x in symbols):
                    spelt[e] = b"".join([code[x] for x in symbols])
        if suffix:
            from tokenizers.models import BPE
            text = {e: x.decode() for e, x in spelt.items()}
            alone = BPE({text[e]: vocab[e] for e in spelt}, [(text[a], text[b]) for a, b in pairs if a in text and b in text and a + b in text])
        else:
            text, alone = {e: e for e in spelt}, self._model
        if any(len(alone.tokenize(x)) != 1 for x in text.values()):
            return
        ranks = {x: vocab[e] for e, x in spelt.items()}
        import tiktoken
        self._bulk = tiktoken.Encoding("bulk", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._lengths = np.zeros(base + len(pairs), np.int64)
        for e, i in ranks.items():
            self._lengths[i] = len(e)
        self._limit = min(self._limit, _BULK_CACHE)

    def _learn_words(self, words: list[str]) -> None:
        """Ids of plain words that aren't known yet, all encoded as one text."""
        if self._final:
            spelt = [w[:-1].translate(self._inner) + self._final[w[-1]] for w in words]
            sizes = list(map(len, spelt))
        else:
            spelt, sizes = words, [len(w.encode()) for w in words]
        ids = np.asarray(self._bulk.encode_ordinary("".join(spelt)), "<u4")
        ends = np.searchsorted(np.cumsum(self._lengths[ids]), np.cumsum(sizes)) + 1
        data, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        self._words.update(zip(words, [data[a:z] for a, z in zip(at, at[1:])]))

    def _probe(self, keep_space: bool, lower: bool) -> bool:
        self._keep_space, self._lower = keep_space, lower
        return all(self._word_by_word(_PLAIN.fullmatch(p)) == self._whole([p])[0] for p in _PROBES)

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self._tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _bpe(self, word: str) -> bytes:
        """Ids of one pre-tokenised word."""
        ids = self._words.get(word)
        if ids is None:
            ids = array("I", [t.id for t in self._model.tokenize(word.translate(self._map))]).tobytes()
            if len(word) <= self._max_piece:
                self._words[word] = ids
        return ids

    def _word_by_word(self, m: re.Match) -> bytes:
        space, word, stop = m.groups()
        if self._lower:
            word = word.lower()
        if not self._keep_space:
            ids = self._bpe(word)
        elif space == "\n":
            ids = self._bpe(space) + self._bpe(word)
        else:
            ids = self._bpe(space + word)
        return ids + self._bpe(stop) if stop else ids

    def _learn(self, missing: list[str]) -> list[str]:
        """Put the ids of new pieces into the cache; returns those that aren't plain."""
        if len(self._words) > self._limit:
            self._words = {}
        new, old, known, bpe = self._new, self._old, self._words, self._bpe
        hard, fresh = [], []
        for p in missing:
            ids = old.get(p)
            if ids is None:
                fresh.append(p)
            else:
                new[p] = ids
        if self._plain and not any(_CUT in p for p in fresh):
            parts = _PLAINS.findall(_CUT.join(fresh) + _CUT) if fresh else []
        else:
            parts = [("", "", "")] * len(fresh)
        keep, lower = self._keep_space, self._lower
        if self._bulk:
            if lower:
                unknown = dict.fromkeys(word.lower() for _, word, _ in parts if word)
            else:
                unknown = dict.fromkeys(" " + word for space, word, _ in parts if space == " ")
            self._learn_words([w for w in unknown if w not in known and len(w) <= self._max_piece])
        for p, (space, word, stop) in zip(fresh, parts):
            if not word:
                hard.append(p)
                continue
            if lower:
                word = word.lower()
            if keep and space == "\n":
                ids = bpe(space) + bpe(word)
            else:
                if keep:
                    word = space + word
                ids = known.get(word)
                if ids is None:
                    ids = bpe(word)
            new[p] = ids + bpe(stop) if stop else ids
        for lo in range(0, len(hard), 1024):
            new.update(zip(hard[lo:lo + 1024], self._whole(hard[lo:lo + 1024])))
        return hard

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self._one(t) if t else b"" for t in texts]

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        ids = list(map(self._new.get, pieces))
        missing = [p for p, x in zip(pieces, ids) if x is None]
        if not missing:
            return ids
        if len(self._new) > self._limit:
            self._old, self._new = self._new, {}
            missing = pieces
        hard = self._learn(missing)
        ids = list(map(self._new.__getitem__, pieces))
        for p in hard:
            if len(p) > self._max_piece:
                del self._new[p]  # too long to keep
        return ids

    def columns(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) of a text column in chunks of bounded text (one
        row at least): the ids of all rows, each row's followed by ``end_id``, and where each
        row's begin (null: the end id alone)."""
        tail = end_id.to_bytes(4, "little")
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(np.r_[0, np.cumsum(sizes)], _BULK_CHUNK if self._bulk else _CHUNK):
            texts = column.slice(lo, hi - lo).cast(pa.large_string()).fill_null("")
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
            easy = pc.if_else(pa.array(odd), "", texts)
            for c in (" ", "\n"):
                easy = pc.replace_substring(easy, c, _CUT + c)
            cut = pc.split_pattern(easy, _CUT)
            pieces = cut.flatten().dictionary_encode()
            at = cut.offsets.to_numpy() - cut.offsets[0].as_py()
            if self._bulk:
                ids = self._piece_ids(pieces.dictionary).take(pieces.indices)
                _, ends, data = ids.buffers()
                at, data = np.frombuffer(ends, np.int64)[at].tolist(), memoryview(data or b"")
                rows = [bytes(data[a:z]) + tail for a, z in zip(at, at[1:])]
            else:
                known = self._look_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
                parts = list(map(known.__getitem__, pieces.indices.to_numpy().tolist()))
                at = at.tolist()
                rows = [b"".join(parts[a:z]) + tail for a, z in zip(at, at[1:])]
            for k in np.flatnonzero(odd).tolist():
                rows[k] = self._one(texts[k].as_py()) + tail
            offsets = np.r_[0, np.cumsum([len(r) // 4 for r in rows])]
            out = np.frombuffer(b"".join(rows), "<u4")
            yield lo, hi, out, offsets

    def _piece_ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces as a column of bytes: the words of all plain pieces are encoded
        as one text, without a Python object a piece; other pieces are looked up one by one."""
        plain = pc.match_substring_regex(pieces, _LED_PIECE if self._keep_space else _PLAIN_PIECE)
        led = pieces.filter(plain)
        if not self._keep_space:
            led = pc.ascii_ltrim(led, " \n")
        words = pc.ascii_rtrim(led, ".,!?;:")
        words = (pc.utf8_lower(words) if self._lower else words).dictionary_encode()
        stops = pc.replace_substring_regex(led, _WORD, "").dictionary_encode()
        stop_ids = pa.array([self._bpe(x) if x else b"" for x in stops.dictionary.to_pylist()], pa.large_binary())
        easy = pc.binary_join_element_wise(self._word_ids(words.dictionary).take(words.indices), stop_ids.take(stops.indices),
                                           pa.scalar(b"", pa.large_binary()))
        hard = pa.array(self._look_up(pieces.filter(pc.invert(plain)).to_pylist()), pa.large_binary())
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(is_plain, np.cumsum(is_plain) - 1, len(easy) + np.cumsum(~is_plain) - 1)
        return pa.concat_arrays([easy, hard]).take(pa.array(place))

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """Ids of different plain words, as the model gets them, as a column of bytes."""
        if not len(words):
            return pa.array([], pa.large_binary())
        _, ends, data = words.buffers()
        ends = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1]
        data, ends = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends[1:] - ends[0]
        spelt = data
        if self._final:
            spelt = self._inner_bytes[data]
            spelt[ends - 1] = self._final_bytes[data[ends - 1]]
        ids = np.asarray(self._bulk.encode_ordinary(spelt.tobytes().decode()), "<u4")
        at = np.r_[0, np.searchsorted(np.cumsum(self._lengths[ids]), ends) + 1] * 4
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids)])

    def _one(self, text: str) -> bytes:
        if _CUT in text or _DOUBLE.search(text):
            pieces = _PIECE.findall(text)
        else:
            pieces = text.replace(" ", "\x01 ").replace("\n", "\x01\n").split(_CUT)
            if not pieces[0]:
                del pieces[0]
        ids = list(map(self._new.get, pieces))
        if None in ids:
            if len(self._new) > self._limit:
                self._old, self._new = self._new, {}
                ids = [None] * len(pieces)
            missing = [p for p, x in zip(pieces, ids) if x is None]
            self._learn(missing)
            ids = list(map(self._new.__getitem__, pieces))
            for p in missing:
                if len(p) > self._max_piece:
                    self._new.pop(p, None)  # too long to keep
        return b"".join(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file (loaded once per Python worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
