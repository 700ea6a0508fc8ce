"""Plan-level guarantees the performance design relies on."""
import datetime as dt
import re

from pyspark.sql import functions as F

from roadrisk import catalog

SF = "/root/testdata/sf0.001"


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unused_lookup_joins_are_removed(spark):
    # K2 reads only keys: neither the customer lookup nor the part lookup may survive.
    k2 = _optimized(catalog.QUERIES["K2_fk_orphans"](spark, SF))
    assert "c_nationkey" not in k2 and "p_type" not in k2
    # M1 never reads the locality: no orders -> customer join (the grid still reads customer).
    m1 = _optimized(catalog.QUERIES["M1_build_features"](spark, SF))
    assert not re.search(r"Join LeftOuter, \(o_custkey", m1)
    # F2 reads LOCALIDAD, so there the lookup stays.
    f2 = _optimized(catalog.QUERIES["F2_clean_accidents"](spark, SF))
    assert re.search(r"Join LeftOuter, \(o_custkey", f2)


def test_reports_on_a_store_read_only_the_window(spark, tables001, tmp_path):
    """M1 and the cross-tab input on a store: the same rows, and a partition filter on every table read."""
    from roadrisk.plans.features import build_features
    from roadrisk.plans.load import StoreTables, with_accident_month, write_store
    from roadrisk.plans.motorcycle import motorcycle_vehicle_rows
    from roadrisk.schemas import CHILD_TABLES
    t, end = tables001, dt.date(1997, 6, 30)
    store = str(tmp_path / "s")
    write_store({"siniestros": t.siniestros, **{c: with_accident_month(t[c], t.siniestros) for c in CHILD_TABLES}}, store)
    st = StoreTables(spark, store, t.grid, end, 1)
    for make in (lambda x: build_features(x, end, 1), lambda x: motorcycle_vehicle_rows(x.siniestros, x.vehiculos, end, 1)):
        assert sorted(map(str, make(st).collect())) == sorted(map(str, make(t).collect()))
        plan = make(st)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("FileScan")[1:] if str(tmp_path) in x]
        assert scans and all("part_year" in re.search(r"PartitionFilters: \[([^\]]*)\]", x)[1] for x in scans)
    assert set(st.vehiculos.columns) == set(t.vehiculos.columns)
