"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import HARD, LONG, frame, words
from public_tokenizers import path
from pyspark.sql import functions as F

from roadrisk.llm import (bpe, decontaminate, jaccard, langid, line_templates, packing, pii, quality, secrets, text,
                          token_files, toxicity)

BYTE, WORD = path("byte_bpe_50k.json"), path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def hard(spark):
    return frame(spark, HARD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_words_and_shingles_match_the_pattern():
    texts = [t for _, t in HARD] + ["A\x00b Zé9-ß", "w" * 70 + " " + "v" * 9]
    for lo, hi, w in text.batch_words(pa.array(texts)):
        for r in range(hi - lo):
            got = [w.low[s:e].tobytes().decode() for s, e in zip(w.start[w.first[r]:w.first[r + 1]], w.end[w.first[r]:w.first[r + 1]])]
            assert got == words(texts[lo + r])
        h, at = w.shingles(3)
        assert len(h) == sum(max(0, len(words(t)) - 2) for t in texts[lo:hi])
    one, two = (next(text.batch_words(pa.array([x, "b"])))[2] for x in ("a", "a "))
    assert one.hash.tolist() == two.hash.tolist()  # a word never runs into the next text


@pytest.mark.parametrize("file", [BYTE, WORD])
def test_encoder_equals_the_library(file):
    import random

    from tokenizers import Tokenizer
    whole, enc = Tokenizer.from_file(file), bpe.Encoder(file, cache=50)
    rng = random.Random(4)
    texts = ["a  b   c\n\n\n d \t x", " \n", "it's we'll 'S", "Σ.ΑΣ", "x\x1cy\x01 z", "Été. straße!\nÑandú,", "　x  y", LONG[:5000]]
    texts += ["".join(rng.choice(" \n\ta1é.'s\x85Z") for _ in range(50)) for _ in range(300)]
    for t in texts * 2:
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_decontamination(spark, hard, none):
    bench = spark.createDataFrame([("i1", "a b c"), ("i2", "A, b; C!"), (None, "other text with the same"), ("i3", None), ("i4", ""),
                                   ("i5", " ".join(LONG.split(" ")[500:520])), ("i5", "null id but")], "item_id string, text string")
    rows = decontaminate.contamination(hard, bench).collect()
    assert len(rows) == len(HARD)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_words, r.n_hit, r.contaminated) for r in by[1] + by[2] + by[3] + by[6]] == [(0, 0, False)] * 4
    assert sorted((r.n_hit, tuple(r["items"]), r.contaminated) for r in by[5]) == [
        (3, ("i1", "i2"), True), (3, ("i1", "i2"), True), (5, (), True)]
    assert (by[4][0].n_words, tuple(by[4][0]["items"])) == (20_000, ("i5",)) and by[4][0].n_hit >= 20
    assert by[None][0].n_hit == 3
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(hard, bench.where("false")).where("n_hit > 0").count()
    # the benchmark in several blocks gives the same rows
    a, b = (sorted(map(str, decontaminate.contamination(hard, bench, block=n).collect())) for n in (4, 100_000))
    assert a == b


def test_packing(spark, hard, none):
    rows = packing.pack(hard, BYTE, with_ids=True).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in HARD}
    assert [(r.length, r.start) for r in rows if r.doc_id == 1] == [(1, 0)]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(none, BYTE).count() == 0


def test_packing_plan_places_every_piece_once():
    rng = np.random.default_rng(5)
    for capacity, n in ((64, 500), (1024, 5000), (16, 3)):
        lengths = rng.integers(1, capacity + 1, n)
        lengths[: n // 3] = lengths[0]
        hist = np.bincount(lengths, minlength=capacity + 1)
        seen, fill = np.zeros_like(hist), {}
        for length, first, count, seq, offset in sorted(packing.plan(hist, capacity)):
            assert first == seen[length]
            seen[length] += count
            for s in range(seq, seq + count):
                fill.setdefault(s, []).append((offset, length))
        assert (seen == hist).all()
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        bound = -(-int(lengths.sum()) // capacity)
        assert len(fill) <= 1.05 * max(bound, (lengths > capacity / 2).sum()) + 2


def test_token_files(spark, hard, none, tmp_path):
    out = token_files.token_files(hard, WORD)
    rows = token_files.digests(spark, out).collect()
    assert len(rows) == len(HARD) and sorted(r.start for r in rows)[0] == 0
    order = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in order] == np.r_[0, np.cumsum([r.n_tokens for r in order])[:-1]].tolist()
    assert [r.doc_id for r in order] == [None, 1, 2, 3, 4, 5, 5, 5, 6, 7, 8]
    some = token_files.read_tokens(spark, out, [1, 5])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString() and some.count() == 4
    assert "ids" not in token_files.read_metadata(spark, out).columns
    empty = token_files.token_files(none, WORD)
    assert token_files.digests(spark, empty).count() == 0


def test_token_files_layout(spark, hard):
    import glob

    import pyarrow.parquet as pq
    out = token_files.token_files(hard, WORD, page_bytes=4096)
    for f in glob.glob(out.removeprefix("file:") + "/part-*.parquet"):
        col = pq.ParquetFile(f).metadata.row_group(0).column(4)
        assert col.path_in_schema.startswith("ids.") and col.has_offset_index
        assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(col.encodings)


def test_language(spark, hard, none):
    train = frame(spark, [(100 + i, t, x) for i in range(8) for t, x in
                          (("the cat and the dog of the house", "en"), ("der Hund und die Katze ist im Haus", "de"), ("any", None))])
    model = langid.train(train)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.predict(hard, model).collect()}
    assert [got[d].lang_pred for d in (1, 2, 3, 6)] == ["und"] * 4 and got[1].score == 0
    assert langid.predict(hard, model).count() == len(HARD) and langid.predict(none, model).count() == 0
    assert langid.train(none) is None
    assert {r.lang_pred for r in langid.predict(hard, None).collect()} == {"und"}
    one = langid.train(train.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in langid.predict(train, one).collect()} == {("en", 1.0)}
    alone = {r.doc_id: r.score for r in langid.predict(hard.where("doc_id = 4"), model).collect()}
    assert alone[4] == got[4].score  # a text's score doesn't depend on its neighbours


def test_codewords_differ():
    for n in (2, 4, 5, 6, 30):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n and (np.abs(code.sum(axis=0)) < n).all()


def test_toxicity(spark, hard, none):
    docs = frame(spark, [(i, ("you vile idiot go away " if i % 5 == 0 else "a calm and plain sentence ") + f"number {i}") for i in range(400)])
    labels = spark.createDataFrame([(i, int(i % 5 == 0), "x") for i in range(400)] + [(0, None, "x"), (9999, 1, "x")],
                                   "doc_id long, toxic int, score string")
    index = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    assert all((r.score >= 0.3) == (d % 5 == 0) for d, r in got.items())
    rows = toxicity.score(hard, index).collect()
    assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {index.base}
    assert toxicity.score(none, index).count() == 0
    assert {r.score for r in toxicity.toxicity(hard, labels.where("false")).collect()} == {0.0}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    v = np.where(rng.random((500, 40)) < 0.08, rng.random((500, 40)), 0).astype(np.float32)
    v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-9)
    index = toxicity.Index(np.arange(40, dtype=np.uint64), np.ones(40), 0.1)
    labels = (rng.random(500) < 0.3).astype(float)
    index.add(v, labels, np.ones(500))
    q = v[:60]
    score, near, best = index.score(q, 7)
    for i in range(60):
        if not q[i].any():
            continue
        cos = v @ q[i]
        kth = np.sort(cos)[-7]
        use = (cos > 0) & (cos >= kth - 1e-6)
        w = cos[use].astype(float) ** 2
        assert score[i] == pytest.approx((w @ labels[use] + 0.1) / (w.sum() + 1), abs=1e-5) and near[i] == use.sum()


def test_quality(spark, hard, none):
    rows = quality.cascade(hard).collect()
    assert len(rows) == len(HARD)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept and by[4].n_words == 20_000
    assert quality.cascade(none).count() == 0
    t = [(1, "a b c a b c x"), (2, "a a a a"), (3, "p q r s p q r t p q r"), (4, "a b c d")]
    got = {r.doc_id: r.n_repeat_words for r in quality.base_measures(frame(spark, t)).collect()}
    assert got == {1: 6, 2: 4, 3: 9, 4: 0}
    sample = quality.base_measures(frame(spark, [(i, "word " * 60 if i % 2 else "## " * 60) for i in range(20)]))
    order = quality.order_rules(sample)
    assert [x[0].name for x in order] and sorted(-x[2] / x[1] for x in order) == [-x[2] / x[1] for x in order]


def test_line_templates(spark, hard, none):
    line = "this very line is in many places {} times a day"
    rows = [(i, f"own text of number{i} and more words here {i} so\n" + line.format(i) + "\nshort one") for i in range(5)]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(frame(spark, rows)).collect()}
    assert [got[i].n_dropped for i in range(5)] == [0, 2, 2, 2, 2] and all("short one" in r.text for r in got.values())
    general = [(i, f"user logged in from the host {x} after a while now") for i, x in enumerate(["alpha", "beta", "gamma", "delta"])]
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring_lines(frame(spark, general)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1}
    twice = frame(spark, [(1, line + "\n" + line), (2, "nothing of the kind is said in here")])
    assert line_templates.drop_recurring_lines(twice).where("n_dropped > 0").count() == 0
    out = line_templates.drop_recurring_lines(hard)
    assert out.count() == len(HARD) and out.columns.count("n_lines") == 1
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text is None and by[2].text == "" and by[4].text == LONG
    assert line_templates.drop_recurring_lines(none).count() == 0


def test_jaccard(spark, hard, none):
    rows = jaccard.near_duplicates(hard).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(HARD)
    assert {r.class_id for d in (1, 2, 3, 6) for r in by[d]} == {1} and by[4][0].class_id == 4
    assert sorted(r.n_copies for r in by[5]) == [0, 1, 1]
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.keep_one(hard)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 5, 7, 8] and kept.columns == hard.columns


def test_jaccard_splits_large_buckets(spark):
    """A group of near copies far above the bucket limit stays one class; a shared passage links nothing."""
    import random
    rng = random.Random(2)
    base = [f"t{rng.randrange(10**6)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(25))
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}x{k}" for k in range(100))) for i in range(100)]
    got = {r.doc_id: r for r in jaccard.near_duplicates(frame(spark, rows), limit=8).collect()}
    assert {got[i].class_id for i in range(150)} == {0}
    assert all(got[1000 + i].class_id == 1000 + i and got[1000 + i].n_links == 0 for i in range(100))


def test_components(spark):
    e = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(40)] + [("a", "b"), ("c", "b")], "a string, b string")
    got = {r.node: r.root for r in jaccard.components(e).collect()}
    assert {got[f"{i:03d}"] for i in range(1, 41)} == {"000"} and got["b"] == got["c"] == "a"
    assert jaccard.components(e.where("false")).count() == 0


def test_pii(spark, hard, none):
    p = pii.Permuter(b"key")
    for n in (1, 2, 3, 10, 97):
        assert sorted(p.permute("t", n, x) for x in range(n)) == list(range(n))
    t = ("x.34@mail7.example.com 4111 1111 1111 1111 4111111111111111 217.94.102.185 999.1.1.1 2020-02-29 2021-02-30 29.02.2020 "
         "DE89 3704 0044 0532 0130 00 +1 (017) 555-7713 123-45-6789 9807915762804490")
    docs = frame(spark, [(1, t), (2, "again 4111-1111-1111-1111."), *HARD])
    new = pii.pseudonymise(docs, b"key")
    rows = {r.doc_id: r for r in new.collect()}
    kinds = [x.kind for x in rows[1].pii] if rows[1].pii else []
    first = next(r for r in new.collect() if r.text and "999.1.1.1" in r.text)
    kinds = [x.kind for x in first.pii]
    assert kinds == ["email", "number", "number", "ipv4", "date", "date", "iban", "phone", "ssn", "number"]
    cards = {first.text[x.start:x.end].replace(" ", "") for x in first.pii if x.kind == "number"}
    linked = next(r for r in new.collect() if r.text and r.text.startswith("again"))
    assert linked.text[6:25].replace("-", "") in cards and "999.1.1.1" in first.text and "2021-02-30" in first.text
    card = linked.text[6:25].replace("-", "")
    assert pii.luhn_digit(card[:-1]) == card[-1] and card != "4111111111111111"
    dates = [first.text[x.start:x.end] for x in first.pii if x.kind == "date"]
    assert dates[0] == "-".join(reversed(dates[1].split(".")))
    back = pii.reveal(new.drop("pii"), b"key")
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(r.text) for r in docs.collect())
    assert pii.pseudonymise(none, b"key").count() == 0 and new.columns.count("pii") == 1


def test_secrets(spark, hard, none):
    key = b"k"
    docs = frame(spark, [(i, f'set token = "{i:040x}"  and some'.replace("0" * 30, f"{i * 7919 + 10**29:030x}")[:80]) for i in range(10, 40)]
                 + [(i, "averylongwordwithoutanydigits" + "abcde"[i % 5] + " in a text") for i in range(50, 80)] + HARD)
    out = secrets.scan(docs, secrets.certain_findings, key=key, path_col="source").collect()
    assert {r.is_secret for r in out if r.doc_id and 10 <= r.doc_id < 40} == {True}
    assert {r.is_secret for r in out if r.doc_id and 50 <= r.doc_id < 80} == {False}
    assert not any(r.doc_id in (1, 2, 3) for r in out)
    assert secrets.scan(none, secrets.certain_findings, key=key).count() == 0
    unlabelled = secrets.scan(docs, secrets.certain_findings(spark.createDataFrame([], "doc_id long, start int, end int, features array<double>")), key=key)
    assert {r.score for r in unlabelled.collect()} == {0.5}


def test_hard_tables_have_the_clashing_columns(hard):
    assert {"n_words", "score", "n_lines", "pii"} <= set(hard.columns) and hard.where(F.col("text").isNull()).count() == 1


def test_plain_pieces_of_a_column_are_encoded_without_a_look_up_each():
    from tokenizers import Tokenizer
    whole, enc = Tokenizer.from_file(WORD), bpe.Encoder(WORD)
    asked, look_up = [], enc._look_up
    enc._look_up = lambda pieces: asked.extend(pieces) or look_up(pieces)
    words = [f"Gl{a}{b}ork{c}" for a in "aeiouß" for b in "bdfgÉñ" for c in ("", "t", "Ü", ".", "?!", "...,;")]
    texts = [" ".join(words), None, "", "one\nTwo. three", "x" * 51 + " " + "é" * 50 + "!" * 11, "ÀÖØÞ àöøþÿ! don't 3rd ÷ × İstanbul ΣΑΣ Ǆ",
             "two  spaces\n\nodd", "mark \x01 in it", " lead", "trail ", ".", "\n", words[0]]
    for lo in (0, 3):  # a slice too
        column = pa.array(texts)[lo:]
        (_, _, ids, offsets), = enc.columns(column, 2)
        want = [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in column.to_pylist()]
        assert [ids[a:z].tolist() for a, z in zip(offsets, offsets[1:])] == want
        assert np.diff(offsets).tolist() == list(map(len, want))
    assert not {p.strip() for p in asked} & set(words)
    assert len(enc._new) < len(words)
    (_, _, ids, _), = enc.columns(pa.array([None, ""], pa.string()), 2)
    assert ids.tolist() == [2, 2]


def test_plain_pieces_that_keep_their_space_are_encoded_without_a_look_up_each():
    from tokenizers import Tokenizer
    whole, enc = Tokenizer.from_file(BYTE), bpe.Encoder(BYTE)
    asked, look_up = [], enc._look_up
    enc._look_up = lambda pieces: asked.extend(pieces) or look_up(pieces)
    words = [f"{led}Gl{a}{b}ork{c}" for led in " \n" for a in "aeiouß" for b in "bdfgÉñ" for c in ("", "t", "Ü", ".", "?!", "...,;")]
    texts = ["first" + "".join(words), None, "", "one\nTwo. three", "x" * 51 + " " + "é" * 50 + "!" * 11, " " + "x" * 51, "\n" + "É" * 50 + ";" * 10,
             "ÀÖØÞ àöøþÿ! don't 3rd ÷ × İstanbul ΣΑΣ Ǆ", "two  spaces\n\nodd", "mark \x01 in it", " lead", "\nled", "trail ", " a.b", ".", "\n", " .", words[0]]
    for lo in (0, 3):  # a slice too
        column = pa.array(texts)[lo:]
        (_, _, ids, offsets), = enc.columns(column, 2)
        want = [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in column.to_pylist()]
        assert [ids[a:z].tolist() for a, z in zip(offsets, offsets[1:])] == want
    assert not set(asked) & set(words)
    assert len(enc._new) + len(enc._words) < len(words)
    (_, _, ids, _), = enc.columns(pa.array([None, ""], pa.string()), 2)
    assert ids.tolist() == [2, 2]
