"""Codes of categories without a window over all values."""
from pyspark.sql import functions as F


def test_codes_are_dense_ranks_whatever_the_partitions(spark):
    from roadrisk.functions.scaling import category_codes
    df = spark.range(0, 60_000, 1, 7).select(F.when(F.col("id") % 11 > 0, F.md5((F.col("id") % 20_000).cast("string"))).alias("c"), "id")
    values = {v: i for i, v in enumerate(sorted({r.c for r in df.collect()} - {None}))}
    got = category_codes(df, "c")
    assert {r.c: r.c_code for r in got.collect()} == values | {None: None} and got.count() == 60_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    empty = category_codes(df.where("id < 0"), "c", "code")
    assert empty.count() == 0 and empty.columns == ["c", "id", "code"]
