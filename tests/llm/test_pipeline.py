"""The pipeline: each stage against its operator or a brute-force version, then the whole."""
from types import SimpleNamespace

import corpus_pipeline
import duckdb
import pyarrow as pa
from helpers import HARD, frame, shingles

from roadrisk.llm import text

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        kept = out.collect()
        if name == "ngram_jaccard_join":
            sets = [shingles(r.text) for r in kept]
            assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        docs = spark.createDataFrame(kept, docs.schema)
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_hard_rows_and_none(spark):
    for rows in (HARD, []):
        docs = frame(spark, rows, clash=False)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_contaminated_documents_go(spark):
    item = duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet' LIMIT 1").fetchall()[0][0]
    docs = frame(spark, [(1, item), (2, "a clean text of its own"), (3, None)], clash=False)
    kept = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3]


def test_python_workers_give_unused_memory_back(spark, monkeypatch):
    given, used, frames = [], [], type(spark.range(0))
    plain = frames.mapInArrow
    with monkeypatch.context() as m:
        m.setattr(pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: given.append(1)))
        assert list(text.releasing(iter)([1, 2])) == [1, 2] and len(given) == 1
        task = text.releasing(iter)([1, 2])
        next(task)
        task.close()  # a task that isn't read to its end
        assert len(given) == 2
    monkeypatch.setattr(frames, "mapInArrow", lambda self, f, *a, **kw: used.append(f) or plain(self, f, *a, **kw))
    docs = frame(spark, HARD, clash=False)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF)
    assert len(used) > 8 and all(f.__qualname__.startswith("releasing.") for f in used)
