"""Quality votes, token alignment and spelling variants against plain versions and on hard tables."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from helpers import HARD, LOWER, frame
from public_tokenizers import path
from tokenizers import Tokenizer

from roadrisk.llm import alignment, bpe, quality_vote, spelling
from roadrisk.llm.queries import QUERIES, SLIP

SF = "/root/testdata/sf0.001"
A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def documents(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()


# --- 11: quality votes ------------------------------------------------------------------------

def test_quality_query_held_out(spark):
    sf = "/root/testdata/sf0.1"
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op11_quality_classifier"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in documents(sf))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    for q in (0, 1):
        of = [r for r in held if label[r.doc_id] == q]
        assert len(of) > 100 and sum(r.predicted == q for r in of) >= 0.97 * len(of)
    # calibration: among rows of like score, the share of label 1 is near the score
    for lo, hi in ((0, 0.3), (0.7, 1.01)):
        some = [r for r in held if lo <= r.score < hi]
        assert abs(np.mean([label[r.doc_id] for r in some]) - np.mean([r.score for r in some])) < 0.15
    # the evidence: no held-out row ever votes, and the label is the example's own
    near = [r for r in rows if r.nearest_id is not None]
    assert near and all(zlib.crc32(r.nearest_id.encode()) % 3 != 1 and label[int(r.nearest_id)] == r.nearest_label for r in near)


def test_votes_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    examples = quality_vote.unit(rng.standard_normal((300, 16)).astype(np.float32))
    examples[200:] = examples[:100]  # ties
    label, vote = rng.integers(0, 2, 300).astype(float), rng.random(300) + 0.5
    m = quality_vote.Model(np.ones(1), np.ones(1), examples, label, vote, [str(i) for i in range(300)], 0.4)
    q = np.vstack([examples[:5], quality_vote.unit(rng.standard_normal((40, 16)).astype(np.float32)), np.zeros((2, 16), np.float32)])
    monkeypatch.setattr(quality_vote, "BLOCK", 64)
    score, near, best, first = m.votes(q, 7)
    for i, v in enumerate(q):
        if not v.any():
            assert (score[i], near[i], best[i], first[i]) == (0.4, 0, 0, -1)
            continue
        cos = (examples @ v).astype(float)
        bar = sorted(cos)[-7]
        w = np.where((cos >= bar - 1e-6) & (cos > 0), cos, 0) ** 2 * vote
        assert score[i] == pytest.approx((w @ label + 0.4) / (w.sum() + 1), abs=1e-5)
        assert near[i] == (w > 0).sum() and best[i] == pytest.approx(cos.max(), abs=1e-5)


def test_latent_space_equals_the_whole_decomposition(spark):
    docs = spark.createDataFrame([(t,) for _, t in documents()][:120], "text string").repartition(3)
    idf = np.ones(quality_vote.DIMS, np.float32)
    space = quality_vote.latent_space(docs, idf, rank=8, passes=12)
    import pyarrow as pa
    x = np.vstack([quality_vote.vectors(row, bucket, hi - lo, idf) for lo, hi, row, bucket in
                   quality_vote.batch_terms(pa.array([r.text for r in docs.collect()]))])
    s = np.linalg.svd(x, compute_uv=False)[:8]
    assert np.linalg.norm(x @ space, axis=0) == pytest.approx(s, rel=0.02)


def test_quality_hard_tables(spark):
    docs, labels = frame(spark, HARD), "doc_id long, quality int, score double"
    some = spark.createDataFrame([(4, 1, 0.1), (5, 0, 0.1), (5, 1, 0.1), (6, None, 0.1), (7, 2, 0.1), (99, 1, 0.1), (None, 1, 0.1), (8, 0, 0.1)], labels)
    rows = quality_vote.quality_votes(docs, some).collect()
    assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
    base = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(base) == 1 and {r.neighbours for r in rows if r.doc_id in (1, 2, 3)} == {0}
    a, b = (r.score for r in rows if r.doc_id == 5 and r.best_cosine == max(x.best_cosine for x in rows if x.doc_id == 5)), rows
    assert list(a) and b
    assert {r.score for r in quality_vote.quality_votes(docs, some.where("false")).collect()} == {0.0}
    assert quality_vote.quality_votes(frame(spark, []), some).count() == 0


# --- 12: token alignment ------------------------------------------------------------------------

def plain_alignment(docs):
    """Every document by the libraries alone: walk both token lists side by side."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    entry = {i: e for e, i in tok.get_vocab().items()}
    byte = {c: b for b, c in bpe._byte_chars().items()}

    def spell(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        want = (" " + (text or "")).encode()
        a, b = tok.encode(" " + (text or ""), add_special_tokens=False).ids, sp.encode(text or "")
        sa, sb = [bytes(byte[c] for c in entry[i]) for i in a], [spell(i) for i in b]
        if not text or b"".join(sa) != want or b"".join(sb) != want:
            return []
        out, i, j = [], 0, 0
        while i < len(a):
            x, y, la, lb = [a[i]], [b[j]], len(sa[i]), len(sb[j])
            i, j = i + 1, j + 1
            while la != lb:
                if la < lb:
                    x.append(a[i])
                    la += len(sa[i])
                    i += 1
                else:
                    y.append(b[j])
                    lb += len(sb[j])
                    j += 1
            out.append((x, y))
        return out

    all_ = [(d, groups(t)) for d, t in docs]
    n = Counter()
    for _, g in all_:
        n.update({(a, b) for x, y in g for a in x for b in y})
    top = defaultdict(int)
    for (a, _), c in n.items():
        top[a] = max(top[a], c)
    out = []
    for d, g in all_:
        links = [(a, b) for x, y in g for a in x for b in y]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(n[k] == top[k[0]] for k in links),
                    sum(n[k] for k in links), hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query_equals_the_libraries(spark):
    rows = QUERIES["op12_token_alignment"](spark, SF).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == plain_alignment(documents())


def odd_texts(n=600):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "ab", "The", "é", "é", "ﬁ", "日本", "😀", "\x00", "▁", "<|endoftext|>", "</s>", "<0x41>",
             "1234", "　", "\xa0", "​", "'s", "aaaaaaaa", "=====", "\r\n", "\x1c", "\x85", "ß", "Ж"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_alignment_of_odd_and_hard_texts(spark, monkeypatch, head):
    docs = list(enumerate(odd_texts())) + [(d, t) for d, t in HARD] + [(700, "日本語" * 400), (701, "😀" * 300 + "\x01" * 500)]
    rows = alignment.alignment(frame(spark, docs).repartition(3), A, B, head=head).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == plain_alignment(docs)


def test_alignment_of_no_rows(spark):
    assert alignment.alignment(frame(spark, []), A, B).count() == 0


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_the_merge_find_the_groups(work):
    rng = np.random.default_rng(work)
    for _ in range(200):
        last = int(rng.integers(1, 40))
        a, b = (np.unique(np.r_[rng.integers(1, last + 1, int(rng.integers(0, 30))), last]) for _ in range(2))
        i, j = alignment.diagonals(a, b, work)
        assert i[0] == j[0] == 0 and (i[-1], j[-1]) == (len(a), len(b)) and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
        assert (np.diff(i + j) <= work + 1).all()  # equal work, but for one equal end
        ga, gb = alignment.groups(a, b, work)
        ends = np.intersect1d(a, b)
        assert ga.tolist() == np.searchsorted(ends, a).tolist() and gb.tolist() == np.searchsorted(ends, b).tolist()


def test_wide_groups_by_distinct_ids(monkeypatch):
    both = alignment.Pieces(A, B)
    texts = ["日本語" * 50 + " and some words", "aaaa" * 30, "", "one two"]
    want = alignment.Aligned(both.encode(texts), both).pairs()
    monkeypatch.setattr(alignment, "_WIDE", 1)
    monkeypatch.setattr(alignment, "_LINKS", 3)
    got = alignment.Aligned(both.encode(texts), both, work=5).pairs()
    assert all((x == y).all() for x, y in zip(got, want)) and len(want[0])


def test_a_small_cache_changes_nothing():
    small, large = alignment.Pieces(A, B, cache=5, max_piece=3), alignment.Pieces(A, B)
    texts = odd_texts(200)
    for lo in range(0, 200, 10):
        x, y = small.encode(texts[lo:lo + 10]), large.encode(texts[lo:lo + 10])
        assert all((p[k] == q[k]).all() and len(p[k]) == len(q[k]) for p, q in zip(x, y) for k in (0, 1))


# --- 13: spelling variants --------------------------------------------------------------------------

def plain_variants(docs, slip, min_count=3):
    n = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= min_count}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)
            if (s := w[:i] + w[i + 1:]) in n:
                near[w].add(s)
                near[s].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        if others and n[best := min(others, key=lambda x: (-n[x], x))] >= 2 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_spelling_query_equals_plain_version(spark, sf):
    rows = QUERIES["op13_spelling_variants"](spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in rows} == plain_variants(documents(sf), SLIP) and len(rows) == len({r.word for r in rows})


def test_no_pair_is_lost(spark):
    """All words of three letters out of four, with accents, an anagram family and one hot beginning."""
    rng = random.Random(2)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(700)}
    words |= {"thing" + "".join(rng.sample("abcdef", 6)) for _ in range(300)}
    docs = [(i, " ".join(w.upper() if "é" not in w else w for w in sorted(words) for _ in range(1 + i % 3))) for i in range(3)] + HARD
    rows = spelling.spelling_variants(frame(spark, docs), min_count=1).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in rows} == plain_variants(docs, None, 1)


def test_chains_of_forms_lead_to_one_root(spark):
    text = " ".join(w for w, n in (("abcdefgh", 1), ("abcdefg", 2), ("abcdef", 4), ("abcdeff", 9), ("abcdxff", 20), ("abcyxff", 50)) for _ in range(n))
    rows = spelling.spelling_variants(frame(spark, [(1, text)]), min_count=1).collect()
    assert {r.root for r in rows} == {"abcyxff"} and sum(r.form is None for r in rows) == 1


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, ""), (3, "a bc def"), (4, "once onces")])).count() == 0


def test_signatures_are_shared_within_distance_two():
    rng = random.Random(8)
    for _ in range(300):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 12)))
        at, c = rng.randrange(len(w)), rng.choice("abcdexé")
        for v in (w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:], "".join(sorted(w))):
            if v:
                x, y = spelling.signatures([w, v])
                assert (x == y).any()
