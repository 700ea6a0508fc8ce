"""Corrections of stored rows (K5), deletes (K4), and changes that are cut off half-way."""
import datetime as dt
import os

import pytest

from roadrisk.schemas import CHILD_TABLES, RAW_ATTRIBUTES

DAY = 86_400_000
JAN, MAR = 979_000_000_000, 984_000_000_000  # January and March 2001


def raw(spark, layer, rows, extra=""):
    """Raw rows given by their named attributes; the others are null."""
    xy = ["x double", "y double"] if layer in ("siniestros", "conheridos", "confallecidos") else []
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in RAW_ATTRIBUTES[layer]] + xy + ([extra] if extra else [])
    names = [f.split()[0] for f in fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(fields))


def accident(form, ms, oid, **more):
    return {"OBJECTID": oid, "FORMULARIO": form, "CIV": 1, "FECHA_HORA_ACC": ms, "GRAVEDAD": "SOLO DANOS"} | more


def vehicle(form, oid, clase, **more):
    return {"OBJECTID": oid, "FORMULARIO": form, "CODIGO_VEHICULO": 1, "CLASE": clase} | more


def empty(spark):
    return {c: raw(spark, c, []) for c in CHILD_TABLES}


@pytest.fixture
def store(spark, tmp_path):
    from roadrisk.functions.cleaning import CLEANERS
    from roadrisk.plans.load import with_accident_month, write_store
    acc = CLEANERS["siniestros"](raw(spark, "siniestros", [accident("A1", JAN, 1), accident("A2", JAN, 2), accident("A3", MAR, 3)]))
    kids = empty(spark) | {"vehiculos": raw(spark, "vehiculos", [vehicle("A1", 11, "BUS"), vehicle("A1", 12, "MOTOCICLETA"),
                                                               vehicle("A2", 13, "BUS"), vehicle("A3", 14, "BUS")])}
    for c in CHILD_TABLES:  # every table has a row that stays
        if c != "vehiculos":
            kids[c] = raw(spark, c, [{"OBJECTID": 90, "FORMULARIO": "A3"}])
    path = str(tmp_path / "store")
    write_store({"siniestros": acc, **{c: with_accident_month(CLEANERS[c](k), acc) for c, k in kids.items()}}, path)
    return path


def vehicles(spark, store):
    from roadrisk.plans.load import read_store
    return sorted(tuple(r) for r in read_store(spark, store, partitions=True)["vehiculos"]
                  .select("FORMULARIO", "OBJECTID", "CLASE", "part_year", "part_month").collect())


def files(store, table, month):
    return sorted(f for f in os.listdir(f"{store}/{table}/part_year=2001/part_month={month}") if f.endswith(".parquet"))


def test_a_correction_stands_once_in_the_right_month(spark, store):
    from roadrisk.plans.load import read_store
    from roadrisk.plans.merge import merge_batch
    march = files(store, "vehiculos", 3)
    acc = raw(spark, "siniestros", [accident("A1", JAN + 31 * DAY, 1, GRAVEDAD="CON HERIDOS"), accident("A2", JAN, 2)])
    kids = empty(spark) | {"vehiculos": raw(spark, "vehiculos", [vehicle("A1", 11, "CAMIONETA"), vehicle("A2", 13, "BUS"),
                                                               vehicle("XX", 15, "BUS")])}
    for again in (False, True):
        got = merge_batch(spark, store, acc, kids)
        rows = read_store(spark, store, partitions=True)["siniestros"].select("FORMULARIO", "GRAVEDAD", "part_month").collect()
        assert sorted(map(tuple, rows)) == [("A1", "CON HERIDOS", 2), ("A2", "SOLO DANOS", 1), ("A3", "SOLO DANOS", 3)]
        assert vehicles(spark, store) == [("A1", 11, "CAMIONETA", 2001, 2), ("A1", 12, "MOTOCICLETA", 2001, 2),
                                          ("A2", 13, "BUS", 2001, 1), ("A3", 14, "BUS", 2001, 3)]
        assert got["vehiculos"] == {"replaced": 0 if again else 2, "written": 0 if again else 2, "orphans": 1}
    assert files(store, "vehiculos", 3) == march  # a month that isn't concerned isn't rewritten


def test_a_child_row_can_move_to_another_accident(spark, store):
    from roadrisk.plans.merge import merge_batch
    kids = empty(spark) | {"vehiculos": raw(spark, "vehiculos", [vehicle("A3", 13, "BUS"), vehicle("A2", None, "BUS"), vehicle("A2", None, "BUS")])}
    for _ in range(2):
        merge_batch(spark, store, raw(spark, "siniestros", []), kids)
    got = vehicles_by_id(spark, store)
    assert got[13] == [("A3", 3)] and got[None] == [("A2", 1), ("A2", 1)]  # rows without an id are added once


def vehicles_by_id(spark, store):
    from roadrisk.plans.load import read_store
    out = {}
    for r in read_store(spark, store, partitions=True)["vehiculos"].collect():
        out.setdefault(r.OBJECTID, []).append((r.FORMULARIO, r.part_month))
    return out


def test_the_greatest_version_of_a_key_counts(spark, store):
    from roadrisk.plans.load import read_store
    from roadrisk.plans.merge import merge_batch
    acc = raw(spark, "siniestros", [accident("A1", JAN, 1, GRAVEDAD=g, v=v) for v, g in ((1, "CON MUERTOS"), (3, "CON HERIDOS"), (2, "SOLO DANOS"))], "v int")
    kids = {c: raw(spark, c, [], "v int") for c in CHILD_TABLES}
    merge_batch(spark, store, acc, kids, version="v")
    assert read_store(spark, store)["siniestros"].where("FORMULARIO = 'A1'").first().GRAVEDAD == "CON HERIDOS"


def test_two_rows_for_one_accident_are_refused(spark, store):
    from roadrisk.plans.load import IntegrityError
    from roadrisk.plans.merge import merge_batch
    before = vehicles(spark, store)
    acc = raw(spark, "siniestros", [accident("A1", JAN, 1, GRAVEDAD="CON HERIDOS"), accident("A1", MAR, 7)])
    with pytest.raises(IntegrityError):
        merge_batch(spark, store, acc, empty(spark))
    assert vehicles(spark, store) == before


@pytest.mark.parametrize("moves", [0, 1])  # vehicles, then accidents are moved
def test_a_delete_that_is_cut_off_is_finished_by_the_next_writer(spark, store, monkeypatch, moves):
    """The process ends after some tables got their months: no survivor is lost, none comes back."""
    from roadrisk.plans import commit
    from roadrisk.plans.load import read_store
    from roadrisk.plans.merge import delete_accidents
    real, left = commit._move, [moves]

    def move(*args):
        if not left[0]:
            raise RuntimeError("lost")
        left[0] -= 1
        real(*args)

    doomed = spark.createDataFrame([("A1",)], "FORMULARIO string")
    monkeypatch.setattr(commit, "_move", move)
    with pytest.raises(RuntimeError, match="lost"):
        delete_accidents(spark, store, doomed)
    monkeypatch.setattr(commit, "_move", real)
    assert commit.recover(spark, store) == 1 and commit.recover(spark, store) == 0
    assert [r[0] for r in vehicles(spark, store)] == ["A2", "A3"]
    assert sorted(r.FORMULARIO for r in read_store(spark, store)["siniestros"].collect()) == ["A2", "A3"]
    assert not os.listdir(f"{store}/_commits")


def test_a_change_that_was_not_sealed_is_dropped(spark, store, monkeypatch):
    from roadrisk.plans import commit
    from roadrisk.plans.merge import delete_accidents

    def fail(*args):
        raise RuntimeError("lost")

    before = vehicles(spark, store)
    monkeypatch.setattr(commit, "_seal", fail)
    with pytest.raises(RuntimeError, match="lost"):
        delete_accidents(spark, store, spark.createDataFrame([("A1",), ("A3",)], "FORMULARIO string"))
    assert commit.recover(spark, store) == 0 and vehicles(spark, store) == before


def test_requests_equal_single_runs(spark, tables001):
    """Dates with and without data, ends of months, leap days: each as a run of its own."""
    from roadrisk.plans.features import build_features
    from roadrisk.plans.prediction import score
    from roadrisk.plans.requests import score_requests
    asked = [(1, 1996, 2, 31), (2, 1999, 12, 31), (3, 2000, 2, 29), (4, 2000, 6, 15), (4, 2000, 6, 15), (5, 1995, 1, 1),
             (6, 2002, 1, 1), (7, 2000, 13, 1), (8, None, 1, 1)]
    req = spark.createDataFrame(asked, "id int, year int, month int, day int")
    got = {}
    for r in score_requests(tables001, req, horizon=(2001, 6), min_year=1995, max_year=2001).collect():
        got.setdefault((r.id, str(r.as_of)), []).append(tuple(r)[5:])
    ends = {(1, "1996-02-29"): 1, (2, "1999-12-31"): 1, (3, "2000-02-29"): 1, (4, "2000-06-15"): 2, (5, "1995-01-01"): 1}
    for (i, day), times in ends.items():
        want = [tuple(r) for r in score(build_features(tables001, dt.date.fromisoformat(day))).collect()] * times
        assert sorted(got.pop((i, day), []), key=str) == sorted(want, key=str)
    assert not got


def test_a_thousand_dates_in_one_plan(spark, tables001):
    from roadrisk.plans.features import build_features
    from roadrisk.plans.requests import day_cells, features_as_of
    dates = spark.sql("SELECT explode(sequence(DATE'1997-01-01', DATE'1999-09-27')) AS as_of")
    assert dates.count() == 1000
    found = features_as_of(day_cells(tables001), dates)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the cells are read twice, for the totals and for their keys; no scan a date
    assert plan.count("orders.parquet") + plan.count("Relation [o_orderkey") <= 6
    got = found.where("as_of = DATE'1998-05-17'").drop("as_of").collect()
    want = build_features(tables001, dt.date(1998, 5, 17)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and want


def test_month_cells_follow_every_change(spark, tables001, tmp_path):
    """Appends, corrections and deletes: the features from cells equal those from the rows."""
    from roadrisk.functions.cleaning import CLEANERS
    from roadrisk.plans import cells
    from roadrisk.plans.features import build_features
    from roadrisk.plans.load import StoreTables, incremental_append, with_accident_month, write_store
    from roadrisk.plans.merge import delete_accidents, merge_batch
    t, store = tables001, str(tmp_path / "store")
    raws = {c: t.raw(c) for c in CHILD_TABLES}
    acc = t.raw("siniestros")
    base = CLEANERS["siniestros"](acc).where("FECHA_ACC >= '1997-06-01' AND FECHA_ACC <= '1999-11-30'")
    write_store({"siniestros": base, **{c: with_accident_month(CLEANERS[c](k), base) for c, k in raws.items()}}, store)

    def same(end):
        got = cells.build_features(spark, store, t.grid, end, 2).collect()
        want = build_features(StoreTables(spark, store, t.grid, end, 2), end, 2).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and want

    assert len(cells.refresh_cells(spark, store)) == 30 and cells.refresh_cells(spark, store) == []
    same("1999-10-14")
    incremental_append(spark, store, acc, raws, dt.date(2000, 1, 10))
    same("1999-12-20")  # the new month has no cells yet
    assert cells.refresh_cells(spark, store) == [(1999, 12)]
    some = acc.join(base.where("FECHA_ACC >= '1999-06-01' AND FECHA_ACC < '1999-06-08'").select("FORMULARIO"), "FORMULARIO", "left_semi")
    merge_batch(spark, store, some.withColumn("FECHA_HORA_ACC", some["FECHA_HORA_ACC"] + 40 * DAY), empty(spark))
    gone = cells.refresh_cells(spark, store)
    assert (1999, 6) in gone and len(gone) <= 3
    same("1999-12-05")
    delete_accidents(spark, store, base.where("FECHA_ACC = '1999-03-09'").select("FORMULARIO"))
    same("1999-12-31")  # March has no cells
    plan = cells.build_features(spark, store, t.grid, "1999-10-14", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "199903" in plan and "199710" in plan  # read row by row


def test_keys_of_a_large_batch_are_not_built_in_the_driver(spark, tmp_path):
    """Their files look small: the streams' merges ran out of the driver's memory."""
    from roadrisk.plans.merge import changed_rows
    path = str(tmp_path / "rows")
    spark.range(300_000).selectExpr("id AS OBJECTID", "'BUS' AS CLASE", "cast(id % 12 AS int) AS part_month").write.parquet(path, compression="zstd")
    rows = spark.read.parquet(path)
    found = changed_rows(rows, rows, "OBJECTID")
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 0


def test_a_batch_without_rows_is_not_merged(spark, tmp_path, monkeypatch):
    from roadrisk.functions.cleaning import CLEANERS
    from roadrisk.plans.load import with_accident_month, write_store
    from roadrisk.schemas import ALL_TABLES
    from roadrisk.sources.files import land_pages
    from roadrisk.streaming import waiting
    store, landing, work = (str(tmp_path / x) for x in ("store", "landing", "work"))
    acc = CLEANERS["siniestros"](raw(spark, "siniestros", [accident("A0", JAN, 1)]))
    kids = {c: raw(spark, c, [{"OBJECTID": 90, "FORMULARIO": "A0"}]) for c in CHILD_TABLES}
    write_store({"siniestros": acc, **{c: with_accident_month(CLEANERS[c](k), acc) for c, k in kids.items()}}, store)
    late = {c: raw(spark, c, [{"OBJECTID": 91, "FORMULARIO": "A1"}]) for c in CHILD_TABLES}
    merges, merge = [], waiting.merge_batch
    monkeypatch.setattr(waiting, "merge_batch", lambda s, d, a, k, **kw: (
        merges.append((s.conf.get("spark.sql.adaptive.enabled"), sum(x.count() for x in k.values()))), merge(s, d, a, k, **kw))[1])
    for layer in ALL_TABLES:
        land_pages(late[layer] if layer in late else raw(spark, "siniestros", [accident("A2", JAN, 2)]), f"{landing}/{layer}", layer)
    waiting.run_delivery(spark, landing, store, work)
    assert merges == [("true", 0)]  # the accident's own batch; the waiting rows found no accident yet
