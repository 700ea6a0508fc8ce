"""Cases that an operator once left out."""
import random

import pytest
from helpers import frame, shingles

from roadrisk.llm import jaccard, pii, secrets

#: A text for each kind, alone in it.
ALONE = {"email": "write to é@x.example now", "iban": "to ES9121000418450200051332 please", "ipv4": "from 10.20.30.40 on",
         "date": "born on 31/12/1999 in", "date_month_first": "born on 12/31/1999 in", "ssn": "no 123-45-6789 it is",
         "number": "card 4111111111111111 it is", "phone": "call (555) 123-4567 now",
         "ipv6": "from 2001:db8::ff00:42:8329 on", "date_short": "born on 31.12.99 in"}
#: Other forms of the same kinds.
FORMS = {"call +33 1 23 45 67 89 now": "phone", "call 030/1234567 now": "phone", "on 1999/12/31 it": "date", "to es9121000418450200051332 please": "iban",
         "write to user@münchen.example now": "email", "write to иван@x.example now": "email", "see fe80:0:0:0:200:F8FF:fe21:67CF there": "ipv6"}


def test_every_kind_alone_in_a_text_is_replaced(spark):
    assert ALONE.keys() == pii.KINDS.keys()
    docs = spark.createDataFrame(list(enumerate(ALONE.values())), "doc_id long, text string")
    new = pii.pseudonymise(docs, b"key")
    got = {r.doc_id: r for r in new.collect()}
    for i, (kind, text) in enumerate(ALONE.items()):
        assert [s.kind for s in got[i].pii] == [kind] and got[i].text != text
    assert {r.doc_id: r.text for r in pii.reveal(new.drop("pii"), b"key").collect()} == dict(enumerate(ALONE.values()))


@pytest.mark.parametrize("text", FORMS)
def test_other_forms_of_a_kind(text):
    p = pii.Permuter(b"key")
    new, spans = pii.replace(text, p)
    assert [k for k, _, _ in spans] == [FORMS[text]] and new != text and len(new) == len(text)
    assert pii.replace(new, p, back=True)[0] == text


@pytest.mark.parametrize("text", ["at 12:30:45 and std::vector", "::", "v10.20.30", "+1 555", "99.99.99", "___@x.example", "aa00bbbbccccddddeeee"])
def test_what_is_no_value_or_cannot_change_is_not_reported(text):
    assert pii.replace(text, pii.Permuter(b"key")) == (text, [])


def test_long_runs_take_linear_time():
    import time
    p, took = pii.Permuter(b"key"), []
    for n in (100_000, 1_000_000):
        t = time.perf_counter()
        assert pii.replace("ab.c" * (n // 4), p)[1] == [] and pii.replace("1:2" * (n // 3), p)[1] == []
        took.append(time.perf_counter() - t)
    assert took[1] < 40 * took[0]


def test_pseudonyms_of_whole_documents_equal_a_plain_walk(spark):
    """Every document of a table against the kinds tried one by one at each place, without prefilter or joint pattern."""
    import re

    import duckdb
    kinds = {k: (re.compile(p), f) for k, (p, f) in pii.KINDS.items()}
    p = pii.Permuter(b"key")

    def walk(text):
        out, at = "", 0
        while at < len(text):
            for kind, (pattern, new_of) in kinds.items():
                m = pattern.match(text, at)
                ends = [] if m is None else pii._iban_ends(m[0]) if kind == "iban" else [len(m[0])]
                new = next((x for e in ends if (x := (new_of(p, m[0][:e], False))) is not None and (size := e)), None)
                if new is not None:
                    out, at = out + new, at + size
                    break
            else:
                out, at = out + text[at], at + 1
        return out

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' WHERE length(text) < 3000").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymise(docs, b"key").collect()}
    assert got == {d: walk(t) for d, t in rows} and sum(got[d] != t for d, t in rows) > 5


def test_repeated_words_whatever_the_hash(spark):
    """Windows whose hashes are all equal, or share few values, give the same numbers as good hashes."""
    from pyspark.sql import functions as F

    from roadrisk.llm.quality import repeat_words
    rng = random.Random(6)
    texts = [[rng.choice("abcdef"[:k]) for _ in range(n)] for k in (1, 2, 3, 6) for n in (0, 1, 2, 3, 4, 5, 9, 40, 300)] + [[f"w{i}" for i in range(500)]]

    def plain(w):
        seen = {}
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i:i + 3]), []).append(i)
        return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})

    df = spark.createDataFrame(list(enumerate(texts)), "id int, w array<string>")
    for window_hash in ("xxhash64({0}, {1}, {2})", "7L", "xxhash64({0}) % 3", "xxhash64({0}, {1}, {2}) % 5"):
        got = {r.id: r.n_repeat_words for r in repeat_words(df, "w", window_hash=window_hash).select("id", F.col("n_repeat_words")).collect()}
        assert got == {i: plain(w) for i, w in enumerate(texts)}


def test_line_families_and_second_documents(spark):
    """Two families in a leaf, a family alone, a long passage in two documents, short lines."""
    from roadrisk.llm import line_templates

    def dropped(texts):
        out = line_templates.drop_recurring_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        return [r.n_dropped for r in out.orderBy("doc_id").collect()]

    names = "ab cd ef gh ij kl".split()
    one = [f"The server reports that user {x} has logged in today" for x in names]
    two = [f"The server reports that disk {x} is nearly full now" for x in names]
    assert dropped(one + two) == [0, 1, 1, 1, 1, 1] * 2 and dropped(one) == [0, 1, 1, 1, 1, 1]
    passage = " ".join(f"{a}{b}word" for a in "abcdefgh" for b in "ijklmnop")
    assert dropped([f"own text one\n{passage}", f"another own text\n{passage}", "x\n" + passage[:-30]]) == [0, 1, 0]
    assert dropped(["Read more here\n" + f"own{chr(97 + i)}" for i in range(10)]) == [0] + [1] * 9
    assert dropped(["Read more here\n" + f"own{chr(97 + i)}" for i in range(9)]) == [0] * 9
    assert dropped(["a line of seven plain words here"] * 2) == [0, 0]


def test_dates_are_linked_in_any_separator_and_stay_in_their_order():
    p = pii.Permuter(b"key")
    for a, b in (("31/12/1999", "31.12.1999"), ("12/31/1999", "12-31-1999")):
        x, y = pii.replace(a, p)[0], pii.replace(b, p)[0]
        assert x != a and [x[:2], x[3:5], x[6:]] == [y[:2], y[3:5], y[6:]]
    assert int(pii.replace("12/31/1999", p)[0][3:5]) > 12
    assert pii.replace("13/13/1999", p)[1] == []


@pytest.mark.parametrize("after", [" NOW", " 2020", " I agree", " 2020 2021 NOW", "", ".", "NOW"])
@pytest.mark.parametrize("iban", ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "GB82 WEST 1234 5698 7654 32"])
def test_an_iban_may_end_before_its_candidate(iban, after):
    p = pii.Permuter(b"key")
    new, spans = pii.replace("to " + iban + after, p)
    assert spans == [("iban", 3, 3 + len(iban))] and new.endswith(after) and iban not in new
    assert new[3:3 + len(iban)] == pii.replace(iban, p)[0]
    assert pii.replace(new, p, back=True)[0] == "to " + iban + after


def test_a_failed_candidate_hides_no_value_of_another_kind():
    p = pii.Permuter(b"key")
    new, spans = pii.replace("ID12 4111 1111 1111 1111", p)
    assert spans == [("number", 5, 24)] and new[5:] == pii.replace("4111 1111 1111 1111", p)[0]


def test_jaccard_counts_every_link_of_large_groups(spark, monkeypatch):
    """Two versions of a text, over 64 variants each, and copies: as brute force, links included."""
    rng = random.Random(5)
    first = [f"t{rng.randrange(10**6)}" for _ in range(300)]
    second = first[:200] + [f"s{rng.randrange(10**6)}" for _ in range(100)]
    rows = []
    for i in range(220):
        w = list((first, second)[i % 2])
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(500 + i, rows[i][1]) for i in range(5)]
    sets = {i: shingles(t) for i, t in rows}
    linked = {i: {j for j in sets if sets[i] != sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    lowest = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in lowest:
                lowest[x] = i
                todo += linked[x] | {j for j in sets if sets[j] == sets[x]}
    want = {i: (lowest[i], len({sets[j] for j in linked[i]})) for i in sets}
    assert len(set(lowest.values())) == 2 and max(n for _, n in want.values()) > 64
    for part in (jaccard.PART, 50):  # in one part, and in several
        monkeypatch.setattr(jaccard, "PART", part)
        assert {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(frame(spark, rows)).collect()} == want


def test_dictionary_counts_words_that_are_rare_in_every_chunk(spark):
    """A word three times in each of several chunks is among the most frequent of the corpus."""
    many = " ".join(f"w{i:04d}" for i in range(3500))
    docs = spark.createDataFrame([(f"{many} seldom seldom seldom" if i else "once",) for i in range(4)], "text string").repartition(4)
    assert secrets.corpus_statistics(docs, "text", 1)[1] == {"seldom"}
    words = secrets.corpus_statistics(docs, "text", 20_000)[1]
    assert len(words) == 3502 and {"seldom", "once", "w0000", "w3499"} <= words
