"""Pages that can't be loaded, landings by id range, and child rows that wait for their accident."""
import json
import os
import time

import pytest

from roadrisk.schemas import ALL_TABLES, CHILD_TABLES


def page(layer, *rows):
    return json.dumps({"features": [{"attributes": r} | ({"geometry": {"x": 1.0, "y": 2.0}} if layer == "siniestros" else {}) for r in rows]})


GOOD = page("siniestros", {"OBJECTID": 1, "FORMULARIO": "A1", "FECHA_HORA_ACC": 979_000_000_000})
BAD = {"cut.json": (GOOD[:-30], "not json"), "error.json": ('{"error": {"code": 500}}', "error page"),
       "clash.json": (GOOD.replace('"OBJECTID": 1', '"OBJECTID": "one"'), "type clash"),
       "other.json": ('{"features": null}', "no features"), "bare.json": ('{"features": [{"geometry": {"x": 1.0}}]}', "no attributes")}


@pytest.fixture
def landing(tmp_path):
    for layer in ALL_TABLES:
        (tmp_path / layer).mkdir()
        (tmp_path / layer / "good.json").write_text(GOOD if layer == "siniestros" else page(layer, {"OBJECTID": 5, "FORMULARIO": "A1", "CODIGO_CAUSA": "1"} if layer == "causas" else {"OBJECTID": 5, "FORMULARIO": "A1"}))
    for name, (text, _) in BAD.items():
        (tmp_path / "siniestros" / name).write_text(text)
    return {layer: str(tmp_path / layer) for layer in ALL_TABLES}


@pytest.mark.parametrize("multiline", [False, True])
def test_every_bad_page_is_listed(spark, landing, multiline):
    from roadrisk.sources.files import bad_pages, read_feature_json
    got = {os.path.basename(r.file): r.reason for r in bad_pages(spark, landing["siniestros"], "siniestros", multiline).collect()}
    assert got == {n: reason for n, (_, reason) in BAD.items()}
    with pytest.raises(Exception, match="bad page of siniestros"):
        read_feature_json(spark, landing["siniestros"], "siniestros", multiline).collect()
    rows = read_feature_json(spark, landing["siniestros"], "siniestros", multiline, on_bad="skip").collect()
    assert [(r.OBJECTID, r.FORMULARIO, r.x) for r in rows] == [(1, "A1", 1.0)]


def test_the_load_refuses_or_sets_aside(spark, landing, tmp_path):
    from roadrisk.plans.load import BadPages, initial_load, read_store
    store, aside = str(tmp_path / "store"), str(tmp_path / "aside")
    with pytest.raises(BadPages, match="5 bad pages, nothing stored.*clash.json: type clash"):
        initial_load(spark, landing, store)
    assert not os.path.exists(store)
    got = initial_load(spark, landing, store, quarantine=aside)
    assert got["bad_pages"] == {n: 5 if n == "siniestros" else 0 for n in ALL_TABLES}
    assert got["rows"] == {n: 1 for n in ALL_TABLES} and not any(got["orphans"].values())
    listed = spark.read.parquet(aside).collect()
    assert sorted(r.reason for r in listed) == sorted(r for _, r in BAD.values())
    assert {json.loads(r.detail)["code"] for r in listed if r.reason == "error page"} == {500}
    assert read_store(spark, store)["siniestros"].count() == 1


def test_only_pages_too(spark, landing, tmp_path):
    """All pages of the accidents are bad: refused, and without a crash where nothing is left to read."""
    from roadrisk.plans.load import BadPages, initial_load
    os.remove(f"{landing['siniestros']}/good.json")
    with pytest.raises(BadPages):
        initial_load(spark, landing, str(tmp_path / "store"))


def test_an_id_range_reads_its_folders_only(spark, tables001, tmp_path):
    from roadrisk.sources.files import land_chunks, read_id_range
    raw, path = tables001.raw("vehiculos").where("OBJECTID % 3 = 0"), str(tmp_path / "chunks")
    assert 9_000 < raw.agg({"OBJECTID": "max"}).first()[0] < 60_000
    land_chunks(raw, path, "vehiculos", size=1_000, page_size=250, last=6_000)
    assert sorted(os.listdir(path))[-2:] == ["chunk=5", "chunk=6"]  # the last range is open-ended
    for lo, hi in ((1_000, 3_000), (1_500, 2_100), (None, 100), (5_900, None), (7_500, 7_700), (90_000, None), (None, None)):
        got = read_id_range(spark, path, "vehiculos", lo, hi, size=1_000, last=6_000)
        want = raw.where(f"OBJECTID >= {lo or 0} AND OBJECTID < {hi or 10**9}")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    some = read_id_range(spark, path, "vehiculos", 1_500, 2_100, size=1_000)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan and ">= 1)" in plan and "<= 2)" in plan


@pytest.fixture
def waiting(spark, tmp_path):
    from roadrisk.functions.cleaning import CLEANERS
    from roadrisk.plans.load import with_accident_month, write_store
    from test_merge import JAN, accident, raw
    acc = CLEANERS["siniestros"](raw(spark, "siniestros", [accident("A0", JAN, 1)]))
    kids = {c: CLEANERS[c](raw(spark, c, [{"OBJECTID": 90, "FORMULARIO": "A0"}])) for c in CHILD_TABLES}
    store, landing, work = (str(tmp_path / x) for x in ("store", "landing", "work"))
    write_store({"siniestros": acc, **{c: with_accident_month(k, acc) for c, k in kids.items()}}, store)
    for layer in ALL_TABLES:
        os.makedirs(f"{landing}/{layer}")
    return store, landing, work


def test_child_rows_wait_for_their_accident(spark, waiting):
    from roadrisk.plans.load import read_store
    from roadrisk.streaming.waiting import run_delivery
    store, landing, work = waiting

    def land(layer, name, text, days_ago=0):
        with open(f"{landing}/{layer}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{landing}/{layer}/{name}", (time.time() - days_ago * 86_400,) * 2)

    def stored():
        return sorted((r.FORMULARIO, r.OBJECTID, r.CLASE) for r in read_store(spark, store)["vehiculos"].collect() if r.OBJECTID != 90)

    # first delivery: a row of a stored accident, one that waits (in two versions), one that waits in vain, a bad page
    land("vehiculos", "a.json", page("vehiculos", {"OBJECTID": 1, "FORMULARIO": "A0", "CLASE": "BUS"}, {"OBJECTID": 2, "FORMULARIO": "A7", "CLASE": "BUS"}), 200)
    land("vehiculos", "b.json", page("vehiculos", {"OBJECTID": 2, "FORMULARIO": "A7", "CLASE": "CAMION"}), 199)
    land("vehiculos", "c.json", page("vehiculos", {"OBJECTID": 3, "FORMULARIO": "A9", "CLASE": "BUS"}), 198)
    land("vehiculos", "d.json", '{"error": {"code": 500}}', 198)
    run_delivery(spark, landing, store, work)
    assert stored() == [("A0", 1, "BUS")]
    assert [(r.reason, os.path.basename(r.file)) for r in spark.read.parquet(f"{work}/bad/batch=*").collect()] == [("error page", "d.json")]
    # second delivery: the accident wakes its rows, and only their last version counts
    land("siniestros", "a.json", page("siniestros", {"OBJECTID": 70, "FORMULARIO": "A7", "FECHA_HORA_ACC": 979_000_000_000}), 190)
    run_delivery(spark, landing, store, work)
    assert stored() == [("A0", 1, "BUS"), ("A7", 2, "CAMION")]
    # later: a correction of a woken row is merged, and the accident's repetition doesn't undo it
    land("vehiculos", "e.json", page("vehiculos", {"OBJECTID": 2, "FORMULARIO": "A7", "CLASE": "MOTOCICLETA"}), 180)
    land("siniestros", "b.json", page("siniestros", {"OBJECTID": 70, "FORMULARIO": "A7", "FECHA_HORA_ACC": 979_000_000_000}), 180)
    run_delivery(spark, landing, store, work)
    assert stored() == [("A0", 1, "BUS"), ("A7", 2, "MOTOCICLETA")]
    # much later: the watermarks have passed the row that waits in vain
    for k, ago in enumerate((20, 1)):
        land("vehiculos", f"z{k}.json", page("vehiculos", {"OBJECTID": 4 + k, "FORMULARIO": f"A{20 + k}"}), ago)
        land("siniestros", f"z{k}.json", page("siniestros", {"OBJECTID": 80 + k, "FORMULARIO": f"B{k}", "FECHA_HORA_ACC": 979_000_000_000}), ago)
        run_delivery(spark, landing, store, work)
    assert "A9" in {r.FORMULARIO for r in spark.read.parquet(f"{work}/unmatched/batch=*").collect()}
    # every page was parsed by one micro-batch: all files are in the intake's log once
    logs = [f"{work}/checkpoint-intake/sources/{k}" for k in range(6)]
    seen = [json.loads(x)["path"] for d in logs if os.path.isdir(d) for f in os.listdir(d) if not f.startswith(".")
            for x in open(f"{d}/{f}").read().split("\n")[1:] if x]
    assert len(seen) == len(set(seen)) == sum(len(os.listdir(f"{landing}/{n}")) for n in ALL_TABLES)
