"""Every registered query: SQL where there is some, a brute-force version elsewhere."""
import collections
import math
import struct
import zlib

import duckdb
import public_tokenizers
import pytest
from helpers import shingles
from tokenizers import Tokenizer

from roadrisk.llm.oracles import ORACLES
from roadrisk.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(rel.project(", ".join(cols)).fetchall())


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_jaccard_query_matches_brute_force(spark):
    docs = {r[0]: shingles(r[1]) for r in table("documents")}
    ids = sorted(docs)
    link = collections.defaultdict(set)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = docs[a], docs[b]
            if x == y or len(x & y) >= 0.8 * len(x | y):
                link[a].add(b)
                link[b].add(a)
    seen = {}
    for a in ids:
        todo = [a]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen[x] = a
                todo += link[x]
    want = {a: (seen[a], len({docs[b] for b in link[a]} - {docs[a]}), sum(docs[b] == docs[a] for b in link[a])) for a in ids}
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in QUERIES["op1_ngram_jaccard_join"](spark, SF).collect()}
    assert got == want


def test_packing_query(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: t.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in table("documents")}
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    seqs, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32 and len(part) == r.length
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.piece, r.start, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    for d, parts in docs.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == len(ids[d])
        assert len(parts) == 1 or (len(ids[d]) > 1024 and all(p[2] == 1024 for p in parts[1:]))
    assert docs.keys() == ids.keys()
    assert len(seqs) <= math.ceil(sum(map(len, ids.values())) / 1024) * 1.02 + 1


def test_token_files_query(spark):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, want = 0, []
    for doc_id, text, *_ in sorted(table("documents")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op8_token_id_output"](spark, SF).collect())) == want


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op5_toxicity"](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    hit = sum(r.predicted and toxic[r.doc_id] for r in held)
    assert hit >= 0.8 * sum(toxic[r.doc_id] for r in held)
    assert hit >= 0.8 * sum(r.predicted for r in held)


def test_secret_scan_finds_planted_tokens(spark):
    import re
    rows = QUERIES["op2_secret_scan"](spark, "/root/testdata/sf0.01").collect()
    found = {(r.doc_id, r.start) for r in rows if r.is_secret}
    want = {(d, m.start(1)) for d, text in duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
            for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', text)}
    assert want and found == want


def test_pii_query_leaves_no_value(spark):
    import re
    pattern = re.compile(r"(?<!\d)\d{16}(?!\d)|[\w.+-]+@[\w-]+\.example\.com|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)")
    text = {r[0]: r[1] for r in table("documents")}
    for r in QUERIES["op9_pii_pseudonyms"](spark, SF).collect():
        assert not set(pattern.findall(text[r.doc_id])) & set(pattern.findall(r.text))
        assert len(pattern.findall(text[r.doc_id])) == len(pattern.findall(r.text))
