"""Bitmaps and sums of keys, and months that are rewritten with few rows shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from roadrisk.plans import commit as C
from roadrisk.plans.keys import KeyMarks, differing_keys
from roadrisk.plans.merge import latest

ROWS = "OBJECTID long, FORMULARIO string, CLASE string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_compared_without_their_text(spark):
    """Other values, values beside nulls, copies, keys of one side: the text of neither side is shuffled."""
    wanted = [(1, "A", "x"), (2, "A", None), (3, "A", "x"), (3, "A", "x"), (4, "B", "y"), (5, "B", "z"), (None, "B", "n"), (7, "C", "p"), (7, "C", "q")]
    held = [(1, "A", "x"), (2, None, "A"), (3, "A", "x"), (4, "B", "y"), (6, "B", "z"), (7, "C", "q"), (7, "C", "p")]
    found = differing_keys(spark.createDataFrame(wanted, ROWS), spark.createDataFrame(held, ROWS), "OBJECTID")
    assert {r.OBJECTID for r in found.collect()} == {None, 2, 3, 5}
    shuffled = re.findall(r"Exchange .*|output.*CLASE.*Exchange", plan(found))
    assert shuffled and not any("CLASE" in x for x in shuffled)
    assert re.search(r"keys=\[OBJECTID#\d+L\], functions=\[partial_sum", plan(found))


def test_marks_find_every_key(spark):
    rows = spark.range(40_000).selectExpr("id AS OBJECTID", "concat('A', id DIV 4) AS FORMULARIO")
    for key, keys in (("OBJECTID", rows.where("OBJECTID % 97 = 5")), ("FORMULARIO", rows.where("FORMULARIO LIKE '%33'"))):
        marked = KeyMarks(keys, key).mark(rows, "_may")
        assert marked.count() == 40_000 and marked.where("_may IS NULL").isEmpty()
        may = marked.where("_may").select(*rows.columns)
        assert keys.exceptAll(may).isEmpty() and may.count() < 6_000


def test_versions_of_few_keys_are_sorted_out(spark):
    """Only keys with several versions are looked at; null keys and null versions as before."""
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "old", 1), (2, "new", 2), (3, "none", None), (3, "some", 1),
                                  (4, "n", None), (None, "old", 1), (None, "new", 3)], "OBJECTID long, v string, landed int")
    kept = {tuple(r) for r in latest(rows, "OBJECTID", "landed").collect()}
    assert kept == {(1, "a"), (1, "b"), (2, "new"), (3, "some"), (4, "n"), (None, "new")}
    one = latest(rows.where("OBJECTID = 1"), "OBJECTID", "landed")
    assert one.count() == 2 and "Exchange" not in plan(one)


@pytest.mark.parametrize("many", [0, 12])
def test_rows_that_nothing_concerns_are_copied(spark, tmp_path, monkeypatch, many):
    """Rows go by id, others move with their accident, the rest of their months is copied
    unshuffled, or shuffled together where a month has many files."""
    monkeypatch.setattr(C, "MANY_FILES", many)
    rows = spark.range(3_000).selectExpr("IF(id % 50 = 0, NULL, id) AS OBJECTID", "concat('A', id % 100) AS FORMULARIO", "concat('c', id) AS CLASE",
                                         "2000 AS part_year", "CAST(IF(id % 100 = 7, NULL, id % 100 % 5 + 1) AS INT) AS part_month")
    rows.write.partitionBy(*C.PARTITIONS).parquet(f"{tmp_path}/causas")
    gone = rows.where("OBJECTID % 30 = 1").select("OBJECTID")
    moved = spark.createDataFrame([("A11", 2001, 1), ("A7", 2000, 2), ("A0", 2000, 3)], "FORMULARIO string, part_year int, part_month int")
    new = spark.createDataFrame([(9_000, "A1", "new", 2000, 4), (9_001, "A1", "new", None, None)],
                                "OBJECTID long, FORMULARIO string, CLASE string, part_year int, part_month int")
    month = lambda m: tmp_path / f"causas/part_year=2000/part_month={m}"
    untouched = {f.name for f in month(5).iterdir()}
    keep = rows.join(gone, "OBJECTID", "left_anti")
    at = moved.toDF("FORMULARIO", "y", "m").withColumn("to", F.lit(True))
    keep = keep.join(at, "FORMULARIO", "left").selectExpr("OBJECTID", "FORMULARIO", "CLASE", "IF(to, y, part_year) AS part_year", "IF(to, m, part_month) AS part_month")
    want = sorted(map(str, keep.union(new).collect()))
    going = rows.join(gone, "OBJECTID", "left_semi").count() + keep.where("FORMULARIO IN ('A11', 'A7', 'A0')").count()
    counts = C.commit(spark, str(tmp_path), {"causas": C.Change("OBJECTID", gone, new, moved)})
    have = spark.read.parquet(f"{tmp_path}/causas").select(*new.columns)
    assert sorted(map(str, have.collect())) == want
    assert counts == {"causas": (going, keep.where("FORMULARIO IN ('A11', 'A7', 'A0')").count() + 2)}
    assert {f.name for f in month(5).iterdir()} == untouched and not month("__HIVE_DEFAULT_PARTITION__").exists()  # all of A7's went


def shuffles(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    return set(found.keySet().mkString(",").split(","))


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    """A delivery's shuffles stayed on disk until the driver happened to collect its garbage."""
    from roadrisk.session import shuffles_dropped
    held = [spark.range(100).groupBy((F.col("id") % 7).alias("k")).count() for _ in range(2)]
    before = shuffles(spark)
    with shuffles_dropped(spark):
        rows = spark.range(100).groupBy((F.col("id") % 5).alias("k")).count()
        rows.write.parquet(str(tmp_path / "rows"))
        assert rows.count() == 5 and shuffles(spark) <= before
    assert [len(df.collect()) for df in held] == [7, 7] and shuffles(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rows_of_known_accidents_are_not_shuffled(spark):
    """Of a delivery's child rows, those of unknown accidents (and without one) wait, the others are left where they are."""
    from roadrisk.streaming.waiting import WAITING_SCHEMA, _split, row_schema
    from roadrisk.schemas import ALL_TABLES, CHILD_TABLES
    kinds = {n: row_schema(n).simpleString() for n in ALL_TABLES}
    at = "TIMESTAMP '2000-01-01 00:00:00'"
    rows = [spark.range(60).selectExpr(f"{at} AS landed", *[
        f"from_json(to_json(named_struct('OBJECTID', id, 'FORMULARIO', IF(id % 20 = 3, NULL, concat('A', id % 30)))), '{kind}') AS {n}" if n == layer
        else f"CAST(NULL AS {kind}) AS {n}" for n, kind in kinds.items()]) for layer in CHILD_TABLES]
    rows = rows[0].union(rows[1]).union(rows[2]).union(rows[3]).union(rows[4])
    unknown = spark.createDataFrame([("A5",), ("A29",), (None,)], "FORMULARIO string")
    waits, here = _split(rows, unknown)
    assert waits.columns == WAITING_SCHEMA.fieldNames() and waits.count() == 5 * (4 + 3)
    assert {r[0] for r in waits.select("FORMULARIO").distinct().collect()} == {"A5", "A29", None}
    assert {c: df.count() for c, df in here.items()} == dict.fromkeys(CHILD_TABLES, 60 - 7)
    waits, here = _split(rows, unknown.limit(0))
    assert waits.isEmpty() and all("Exchange" not in plan(df) and df.count() == 60 for df in here.values())
