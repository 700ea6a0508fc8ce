"""The monthly append where dates, keys and pages don't arrive in order."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

DEC = dt.date(2001, 1, 24)


@pytest.fixture
def store(spark, tables001, tmp_path):
    from roadrisk.plans.load import with_accident_month, write_store
    from roadrisk.schemas import CHILD_TABLES
    t = tables001
    base = t.siniestros.filter(F.col("FECHA_ACC") <= F.lit(dt.date(2000, 11, 30)))
    path = str(tmp_path / "store")
    write_store({"siniestros": base, **{c: with_accident_month(t[c], base) for c in CHILD_TABLES}}, path)
    return path


def _raw(t):
    from roadrisk.schemas import CHILD_TABLES
    return t.raw("siniestros"), {c: t.raw(c) for c in CHILD_TABLES}


def _duplicate_keys(spark, store):
    from roadrisk.plans.load import read_store
    return read_store(spark, store)["siniestros"].groupBy("FORMULARIO").count().where("count > 1").count()


def test_corrected_dates_add_no_key_twice(spark, tables001, store):
    from roadrisk.plans.load import incremental_append, read_store
    acc, kids = _raw(tables001)
    old = acc.orderBy("OBJECTID").limit(40).withColumn("FECHA_HORA_ACC", F.lit(977_000_000_000))  # now in December 2000
    for _ in range(2):
        incremental_append(spark, store, acc.join(old.select("FORMULARIO"), "FORMULARIO", "left_anti").unionByName(old), kids, DEC)
        assert _duplicate_keys(spark, store) == 0
    want = tables001.siniestros.where("FECHA_ACC <= DATE '2000-12-31'").select("FORMULARIO").union(old.select("FORMULARIO")).distinct().count()
    assert read_store(spark, store)["siniestros"].count() == want


def test_accidents_without_a_date_are_added_once(spark, tables001, store):
    from roadrisk.plans.load import incremental_append
    acc, kids = _raw(tables001)
    none = acc.limit(3).withColumns({"FORMULARIO": F.concat(F.lit("N"), "FORMULARIO"), "FECHA_HORA_ACC": F.lit(None).cast("long")})
    vehicles = kids["vehiculos"].limit(4).withColumn("FORMULARIO", F.lit(none.first().FORMULARIO))
    kids["vehiculos"] = kids["vehiculos"].unionByName(vehicles)
    first = incremental_append(spark, store, none, kids)
    assert first["siniestros"] == 3 and first["vehiculos"] == 4
    assert not any(incremental_append(spark, store, none, kids).values()) and _duplicate_keys(spark, store) == 0


def test_late_child_rows_are_added(spark, tables001, store):
    from roadrisk.plans.load import append_late_children, incremental_append, read_store
    acc, kids = _raw(tables001)
    early = {**kids, "vehiculos": kids["vehiculos"].where("CODIGO_VEHICULO % 2 = 0 OR CODIGO_VEHICULO IS NULL")}
    incremental_append(spark, store, acc, early, DEC)
    incremental_append(spark, store, acc, kids, DEC)  # the rest came
    want = tables001.siniestros.where("FECHA_ACC <= DATE '2000-12-31'").select("FORMULARIO")
    stored = read_store(spark, store)["vehiculos"]
    assert stored.count() == tables001.vehiculos.join(want, "FORMULARIO", "left_semi").count()
    late = kids["causas"].where(F.col("FORMULARIO") == want.first().FORMULARIO).limit(1).withColumn("NOMBRE", F.lit("LATE"))
    assert append_late_children(spark, store, {"causas": late}) == {"causas": 1}
    assert append_late_children(spark, store, {"causas": late}) == {"causas": 0}


def test_child_rows_keep_their_own_date(spark, tables001, store):
    """A child row whose date differs from its accident's lies in the accident's month, unchanged."""
    from roadrisk.plans.load import incremental_append, read_store
    acc, kids = _raw(tables001)
    month = 31 * 86_400_000
    kids["conheridos"] = kids["conheridos"].withColumn("FECHA_HORA_ACC", F.col("FECHA_HORA_ACC") - month)
    added = incremental_append(spark, store, acc, kids, DEC)
    rows = read_store(spark, store, partitions=True)["conheridos"].where("part_year = 2000 AND part_month = 12")
    assert rows.count() == added["conheridos"] > 0
    assert rows.where("MES_NRO_OCURRENCIA_ACC <> month(FECHA_ACC)").count() == 0
    assert rows.where("MES_NRO_OCURRENCIA_ACC = 11").count() > 0
    assert set(read_store(spark, store)["vehiculos"].columns) == set(tables001.vehiculos.columns)


def test_delete_removes_accidents_and_children(spark, tables001, store):
    from roadrisk.plans.load import read_store
    from roadrisk.plans.merge import delete_accidents
    before = read_store(spark, store)["siniestros"]
    month = before.where("ANO_OCURRENCIA_ACC = 1996 AND MES_NRO_OCURRENCIA_ACC = 3").select("FORMULARIO")
    some = before.where("ANO_OCURRENCIA_ACC = 1997").orderBy("FORMULARIO").limit(5).select("FORMULARIO")
    doomed = [r[0] for r in month.union(some).collect()]
    n = before.count()
    gone = delete_accidents(spark, store, spark.createDataFrame([(x,) for x in doomed], "FORMULARIO string"))
    assert gone["siniestros"] == len(doomed) and gone["vehiculos"] > 0
    after = read_store(spark, store)
    assert after["siniestros"].count() == n - len(doomed)
    assert all(df.where(F.col("FORMULARIO").isin(doomed)).count() == 0 for df in after.values())


def test_scratch_is_cleared(spark, tables001, store):
    import os

    from roadrisk.plans.load import incremental_append
    from roadrisk.session import checkpoint_root
    root = os.path.join(checkpoint_root(spark).removeprefix("file:"), "roadrisk")
    acc, kids = _raw(tables001)
    incremental_append(spark, store, acc, kids, DEC)
    assert not [x for x in os.listdir(root) if x.startswith("month-stage")] if os.path.isdir(root) else True


def test_plain_geojson_files(spark, tmp_path):
    import json

    from roadrisk.operators.windows import dedupe_grid
    from roadrisk.sources.files import read_corridor_grid

    def write(name, names):
        features = [{"type": "Feature", "geometry": None, "properties": {"MVICIV": 7, "MVINOMBRE": x}} for x in names]
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))

    write("a.geojson", ["ZZ FIRST", "AA SECOND"])
    write("b.geojson", ["AA THIRD"])
    grid = read_corridor_grid(spark, str(tmp_path))
    assert [r.MVINOMBRE for r in grid.orderBy("pos").collect()] == ["ZZ FIRST", "AA SECOND", "AA THIRD"]
    assert [r.MVINOMBRE for r in dedupe_grid(grid).collect()] == ["ZZ FIRST"]
    write("c.geojson", [])
    with pytest.raises(ValueError):
        read_corridor_grid(spark, str(tmp_path))
