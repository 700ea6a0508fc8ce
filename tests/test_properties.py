"""Invariants on the sf0.001 tables (roll-ups, normalisations, loads, idempotence)."""
import datetime as dt

from pyspark.sql import functions as F

from roadrisk import catalog
from roadrisk.operators import aggregates as A
from roadrisk.plans.features import build_features, build_features_five_query

SF = "/root/testdata/sf0.001"
END = "2000-12-31"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_single_pass_equals_five_query_form(tables001):
    a = build_features(tables001, END)
    b = build_features_five_query(tables001, END).select(*a.columns)
    assert _rows(a) == _rows(b)
    assert a.count() == 31  # adapter figure at sf0.001


def test_rollups_are_consistent(tables001):
    t = tables001
    a6 = A.corridor_hour_totals(t.siniestros, t.conheridos, t.confallecidos, t.grid, END)
    a7 = A.corridor_day_block_totals(a6)
    a8 = A.corridor_block_totals(a7)
    from_a7 = a7.groupBy("MVINOMBRE", "HORARIO").agg(*[F.sum(c).alias(c) for c in A.MEASURES])
    assert _rows(from_a7) == _rows(a8.select(*from_a7.columns))
    tot6 = a6.join(a8.select("MVINOMBRE").distinct(), "MVINOMBRE").agg(*[F.sum(c) for c in A.MEASURES]).collect()[0]
    tot8 = a8.agg(*[F.sum(c) for c in A.MEASURES]).collect()[0]
    assert tuple(tot6) == tuple(tot8) == (69, 7, 29, 5, 21)


def test_crosstab_normalisations(spark):
    allp = catalog.QUERIES["A11_crosstab_all"](spark, SF)
    assert abs(allp.agg(F.sum("pct")).collect()[0][0] - 100.0) < 1e-9
    rowp = catalog.QUERIES["A12_crosstab_row"](spark, SF)
    for r in rowp.groupBy("GRAVEDAD", "CLASE_ACC").agg(F.sum("pct").alias("s")).collect():
        assert abs(r.s - 100.0) < 1e-9
    assert allp.count() == 90 and allp.agg(F.sum("n")).collect()[0][0] == 1163


def test_initial_load_leaves_no_orphans(spark, tables001, tmp_path):
    from roadrisk.operators.integrity import orphan_counts
    from roadrisk.plans.load import initial_load, land_layers, read_store
    from roadrisk.schemas import ALL_TABLES, CHILD_TABLES
    store = str(tmp_path / "store")
    landing = land_layers({n: tables001.raw(n) for n in ALL_TABLES}, str(tmp_path / "landing"))
    report = initial_load(spark, landing, store)
    assert report["rows"]["siniestros"] == 1500 and not any(report["orphans"].values())
    st = read_store(spark, store)
    assert all(r.orphan_rows == 0 for r in orphan_counts({c: st[c] for c in CHILD_TABLES},
                                                         st["siniestros"]).collect())
    assert st["siniestros"].count() == 1500


def test_rejected_batch_writes_nothing(spark, tables001, tmp_path):
    import pytest

    from roadrisk.plans.load import IntegrityError, check_batch
    acc = tables001.siniestros
    dup = acc.unionByName(acc.filter(F.col("ANO_OCURRENCIA_ACC") == 1996))
    with pytest.raises(IntegrityError):
        check_batch({"siniestros": dup})


def test_monthly_append_is_idempotent(spark, tables001, tmp_path):
    from roadrisk.plans.load import incremental_append, read_store, with_accident_month, write_store
    from roadrisk.schemas import CHILD_TABLES
    t = tables001
    store = str(tmp_path / "store")
    base = t.siniestros.filter(F.col("FECHA_ACC") <= F.lit(dt.date(2000, 11, 30)))
    write_store({"siniestros": base, **{c: with_accident_month(t[c], base) for c in CHILD_TABLES}}, store)
    children = {c: t.raw(c) for c in CHILD_TABLES}
    first = incremental_append(spark, store, t.raw("siniestros"), children, dt.date(2001, 1, 24))
    second = incremental_append(spark, store, t.raw("siniestros"), children, dt.date(2001, 1, 24))
    assert first["siniestros"] > 0 and all(v == 0 for v in second.values())
    st = read_store(spark, store)
    want = t.siniestros.filter(F.col("FECHA_ACC") <= F.lit(dt.date(2000, 12, 31))).count()
    assert st["siniestros"].count() == want
    assert st["siniestros"].groupBy("FORMULARIO").count().filter("count > 1").count() == 0


def test_monthly_stream_appends_landed_pages(spark, tables001, tmp_path):
    from roadrisk.functions.calendar import previous_month_filter
    from roadrisk.operators.joins import keep_known
    from roadrisk.plans.load import read_store, with_accident_month, write_store
    from roadrisk.schemas import CHILD_TABLES
    from roadrisk.sources.files import land_pages
    from roadrisk.streaming.monthly import start_monthly_stream
    t = tables001
    store = str(tmp_path / "store")
    base = t.siniestros.filter(F.col("FECHA_ACC") <= F.lit(dt.date(2000, 11, 30)))
    write_store({"siniestros": base, **{c: with_accident_month(t[c], base) for c in CHILD_TABLES}}, store)
    month = previous_month_filter(t.siniestros, dt.date(2001, 1, 24)).select("FORMULARIO")
    raw_month = keep_known(t.raw("siniestros"), month)
    land_pages(raw_month, str(tmp_path / "landing" / "siniestros"), "siniestros", page_size=10)
    kids = {}
    for c in CHILD_TABLES:
        kids[c] = str(tmp_path / "landing" / c)
        land_pages(t.raw(c), kids[c], c)
    q = start_monthly_stream(spark, str(tmp_path / "landing" / "siniestros"), kids, store,
                             str(tmp_path / "stream-ckpt"))
    q.awaitTermination(300)
    st = read_store(spark, store)
    assert st["siniestros"].count() == base.count() + month.count()
    want_inj = keep_known(t.conheridos, t.siniestros.filter(F.col("FECHA_ACC") <= F.lit(dt.date(2000, 12, 31))))
    assert st["conheridos"].count() == want_inj.count()
