"""What the loads move and write: compressed pages, narrow child rows, no driver-built join sides."""
import glob

from pyspark.sql import functions as F

from roadrisk.schemas import CHILD_TABLES


def test_landed_pages_are_compressed(spark, tables001, tmp_path):
    from roadrisk.sources.files import land_chunks, land_pages, read_feature_json, read_id_range
    raw = tables001.raw("causas").limit(500)
    land_pages(raw, str(tmp_path / "pages"), "causas")
    land_chunks(raw, str(tmp_path / "chunks"), "causas")
    files = [f for p in ("pages", "chunks") for f in glob.glob(f"{tmp_path}/{p}/**/part-*", recursive=True)]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert read_feature_json(spark, str(tmp_path / "pages"), "causas").count() == 500
    assert read_id_range(spark, str(tmp_path / "chunks"), "causas").count() == 500


def test_child_rows_are_made_after_the_shuffles(spark, tables001, tmp_path):
    """A store of source rows holds the rows that the clean tables have, and what is shuffled
    has no column of text but the key and a flag."""
    from roadrisk.plans.load import PARTITIONS, read_store, with_accident_month, write_store
    t = tables001
    for c in CHILD_TABLES:
        text = [f for f, kind in t.source(c).dtypes if kind == "string"]
        assert set(text) <= {"FORMULARIO", "l_returnflag", "o_orderpriority"}, (c, text)
    write_store({c: with_accident_month(t.source(c), t.siniestros) for c in CHILD_TABLES}, str(tmp_path), made_of=t.made_of)
    for c in CHILD_TABLES:
        want = with_accident_month(t[c], t.siniestros)
        have = spark.read.parquet(f"{tmp_path}/{c}").select(*t[c].columns, *PARTITIONS)
        assert want.exceptAll(have).isEmpty() and have.exceptAll(want).isEmpty(), c
    assert glob.glob(f"{tmp_path}/causas/**/*.zstd.parquet", recursive=True)


def test_a_batch_is_not_built_in_the_driver(spark):
    """The staged side of a merge's join is shuffled, however small its files make it look."""
    from roadrisk.plans.merge import _any_size
    rows, keys = spark.range(100).withColumn("v", F.col("id") * 2), spark.range(10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(rows.join(keys, "id"))
    for how in ("inner", "left_semi", "left_anti"):
        assert "SortMergeJoin" in plan(rows.join(_any_size(keys), "id", how))


def test_only_accidents_with_other_rows_are_compared(spark, tmp_path):
    """Sums by accident see other values, values that changed places with nulls, and copies."""
    from roadrisk.plans.load import may_match, stage_differing
    schema = "FORMULARIO string, a string, b string"
    rows = [("A1", "x", None), ("A1", "y", "z"), ("A2", "x", "y"), ("A2", "x", "y"), ("A3", None, "q"), ("A4", "k", "k"), ("A5", "n", "n"), (None, "o", "o")]
    held = [("A1", "y", "z"), ("A1", "x", None), ("A2", "x", "y"), ("A3", "q", None), ("A4", "k", "l"), ("A6", "m", "m")]
    wanted, stored = spark.createDataFrame(rows, schema), spark.createDataFrame(held, schema)
    found = stage_differing(spark, str(tmp_path), "causas", wanted, stored)
    assert {r.FORMULARIO for r in found.collect()} == {"A2", "A3", "A4", "A5", None}
    many = spark.range(20_000).selectExpr("concat('A', id) AS FORMULARIO")
    keys = many.where("FORMULARIO LIKE '%77'")
    kept = may_match(many, keys)
    assert keys.exceptAll(kept).isEmpty() and kept.count() < 3_000
    assert may_match(many, keys.limit(0)).isEmpty()


def test_late_rows_that_are_stored_move_no_text(spark, tables001, tmp_path):
    """Child rows that the store has are found by their accidents' sums; what differs is added, once."""
    from roadrisk.plans.load import append_late_children, read_store, with_accident_month, write_store
    t, store = tables001, str(tmp_path / "store")
    write_store({"siniestros": t.siniestros, **{c: with_accident_month(t[c], t.siniestros) for c in CHILD_TABLES}}, store)
    raw = t.raw("vehiculos").limit(300)
    assert append_late_children(spark, store, {"vehiculos": raw})["vehiculos"] == 0
    other = raw.limit(7).withColumn("CLASE", F.lit("TRACTOR"))
    assert append_late_children(spark, store, {"vehiculos": raw.unionByName(other)})["vehiculos"] == 7
    assert append_late_children(spark, store, {"vehiculos": raw.unionByName(other)})["vehiculos"] == 0
    assert read_store(spark, store)["vehiculos"].where("CLASE = 'TRACTOR'").count() == 7


def test_pages_of_source_rows(spark, tables001, tmp_path):
    """Pages made of narrow rows hold the raw layer, and their shuffle has no column of its text."""
    from roadrisk.sources.files import as_pages, land_pages, read_feature_json
    t = tables001
    for c in CHILD_TABLES:
        pages = as_pages(t.source(c), c, layer_of=t.layer_of)
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Repartition") == 1 and "feature#" not in plan[plan.index("Repartition"):], c
        land_pages(t.source(c), str(tmp_path / c), c, layer_of=t.layer_of)
        have, want = read_feature_json(spark, str(tmp_path / c), c), t.raw(c)
        assert want.exceptAll(have).isEmpty() and have.exceptAll(want).isEmpty(), c


def test_a_stored_table_is_summed_once_for_many_batches(spark, tables001, tmp_path, monkeypatch):
    """Each micro-batch of a late layer read and summed the whole stored table anew."""
    from roadrisk.plans import load
    from roadrisk.sources.files import as_pages, land_pages
    from roadrisk.streaming import monthly
    t, store, landing = tables001, str(tmp_path / "store"), str(tmp_path / "landing")
    load.write_store({"siniestros": t.siniestros, **{c: load.with_accident_month(t[c].where("OBJECTID < 800") if c == "causas" else t[c], t.siniestros) for c in CHILD_TABLES}}, store)
    early = t.raw("causas").where("OBJECTID < 8000")
    load.append_late_children(spark, store, {"causas": early})
    land_pages(t.raw("siniestros").limit(0), f"{landing}/siniestros", "siniestros")
    for c in CHILD_TABLES:
        land_pages(t.raw(c).limit(0), f"{landing}/{c}", c)
    # four files: two that the store has, two with rows that it lacks, one of these twice
    for lo, hi in ((0, 4_000), (4_000, 8_000), (8_000, 16_000), (8_000, 16_000), (16_000, 1 << 40)):
        rows = t.raw("causas").where(f"OBJECTID >= {lo} AND OBJECTID < {hi}")
        as_pages(rows, "causas").coalesce(1).select("features").write.mode("append").json(f"{landing}/causas")
    summed, compared = [], []
    stage, differing = monthly.stage_stored_sums, load.stage_differing
    monkeypatch.setattr(monthly, "stage_stored_sums", lambda *a: (summed.append(a[2]), stage(*a))[1])
    monkeypatch.setattr(load, "stage_differing", lambda *a: (compared.append((a[2], a[5] is not None)), differing(*a))[1])
    kids = {c: f"{landing}/{c}" for c in CHILD_TABLES}
    monthly.run_monthly_streams(spark, f"{landing}/siniestros", kids, store, str(tmp_path / "ckpt"), files_per_trigger=1)
    want, have = load.with_accident_month(t["causas"], t.siniestros), load.read_store(spark, store, partitions=True)["causas"]
    have = have.select(*want.columns)
    assert want.exceptAll(have).isEmpty() and have.exceptAll(want).isEmpty()
    assert summed == ["causas"]
    batches = [x for c, x in compared if c == "causas"]
    assert len(batches) >= 5 and batches == [False] + [True] * (len(batches) - 1)
