"""Unit tests on tiny literal frames, one per data trap of the blueprint."""
import datetime as dt

from pyspark.sql import functions as F

from roadrisk.functions.calendar import (clamp_as_of, derive_calendar, in_window,
                                         previous_month_filter, window_start)
from roadrisk.functions.cleaning import (clean_accidents, clean_actors, clean_causes,
                                         clean_vehicles)
from roadrisk.functions.features import hour_block, label_to_priority, severity_index
from roadrisk.functions.scaling import minmax_scale
from roadrisk.operators import aggregates as A
from roadrisk.operators.windows import dedupe_grid, dedupe_grid_window
from roadrisk.plans.features import build_features_from


def test_window_half_open_and_feb29(spark):
    # Start exclusive, end inclusive; Feb 29 minus three years is Feb 28.
    end = dt.date(2020, 2, 29)
    assert window_start(end) == dt.date(2017, 2, 28)
    days = [dt.date(2017, 2, 28), dt.date(2017, 3, 1), end, dt.date(2020, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = [r.d for r in df.filter(in_window(F.col("d"), end)).orderBy("d").collect()]
    assert kept == [dt.date(2017, 3, 1), end]


def test_epoch_to_local_calendar(spark):
    # Epoch ms is UTC, local = UTC - 5h; Spanish names; 1 = Monday.
    ms = 1640995200000  # 2022-01-01 00:00 UTC = 2021-12-31 19:00 local (a Friday)
    df = spark.createDataFrame([(ms,)], "FECHA_HORA_ACC long")
    r = derive_calendar(df).collect()[0]
    assert r.FECHA_ACC == dt.date(2021, 12, 31)
    assert (r.ANO_OCURRENCIA_ACC, r.MES_NRO_OCURRENCIA_ACC, r.DIA_MES_OCURRENCIA_ACC) == (2021, 12, 31)
    assert r.HORA_OCURRENCIA_ACC == 19
    assert r.MES_OCURRENCIA_ACC == "DICIEMBRE"
    assert (r.DIA_OCURRENCIA_ACC, r.DIA_NRO_OCURRENCIA_ACC) == ("VIERNES", 5)
    # one row per weekday: names with accents and numbers 1..7
    base = 1641081600000  # 2022-01-02 00:00 UTC = Saturday 2022-01-01 19:00 local
    rows = derive_calendar(spark.createDataFrame([(base + i * 86400000,) for i in range(7)],
                                                 "FECHA_HORA_ACC long")).collect()
    got = {r.DIA_NRO_OCURRENCIA_ACC: r.DIA_OCURRENCIA_ACC for r in rows}
    assert got == {1: "LUNES", 2: "MARTES", 3: "MIÉRCOLES", 4: "JUEVES", 5: "VIERNES",
                   6: "SÁBADO", 7: "DOMINGO"}


def test_session_time_zone_does_not_matter(spark):
    ms = 1640995200000
    df = spark.createDataFrame([(ms,)], "FECHA_HORA_ACC long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = derive_calendar(df).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.FECHA_ACC, r.HORA_OCURRENCIA_ACC) == (dt.date(2021, 12, 31), 19)


def _acc(spark, rows):
    return spark.createDataFrame(rows, "FORMULARIO string, CIV int, FECHA_ACC date, "
                                       "DIA_OCURRENCIA_ACC string, HORA_OCURRENCIA_ACC int, GRAVEDAD string")


def test_useless_civ_and_null_keys_dropped(spark):
    # T4, T5: CIV null or 0 dropped; null day/hour keys dropped before grouping.
    d = dt.date(2020, 6, 1)
    acc = _acc(spark, [("A1", 0, d, "LUNES", 3, "SOLO DANOS"), ("A2", None, d, "LUNES", 3, "SOLO DANOS"),
                       ("A3", 7, d, None, 3, "SOLO DANOS"), ("A4", 7, d, "LUNES", None, "SOLO DANOS"),
                       ("A5", 7, d, "LUNES", 3, "SOLO DANOS"), ("A6", 7, d, "LUNES", 3, "SOLO DANOS")])
    out = A.accident_counts(acc, "2020-12-31").collect()
    assert [(r.CIV, r.DIA_OCURRENCIA_ACC, r.HORA_OCURRENCIA_ACC, r.accidentes) for r in out] == [(7, "LUNES", 3, 2)]


def test_grid_first_in_file_order_before_name_check(spark):
    # A CIV whose first row has no name is lost even if a later row is named.
    g = spark.createDataFrame([(1, 10, None), (2, 10, "NAMED"), (3, 20, "FIRST"), (4, 20, "SECOND"),
                               (5, None, "NOCIV")], "pos long, CIV int, MVINOMBRE string")
    a = sorted((r.CIV, r.MVINOMBRE) for r in dedupe_grid(g).collect())
    b = sorted((r.CIV, r.MVINOMBRE) for r in dedupe_grid_window(g).collect())
    assert a == b == [(10, None), (20, "FIRST")]


def test_double_count_of_injured(spark):
    # CON HERIDOS accident with 1 killed and 2 injured: heridos = 2 + 2 = 4.
    d = dt.date(2020, 6, 1)
    acc = _acc(spark, [("A1", 7, d, "LUNES", 23, "CON HERIDOS")])
    inj = spark.createDataFrame([("A1", "PEATON"), ("A1", "CONDUCTOR")], "FORMULARIO string, CONDICION string")
    kil = spark.createDataFrame([("A1", "CICLISTA")], "FORMULARIO string, CONDICION string")
    grid = spark.createDataFrame([(1, 7, "AV UNO")], "pos long, CIV int, MVINOMBRE string")
    r = build_features_from(acc, inj, kil, grid, "2020-12-31").collect()[0]
    assert (r.accidentes, r.muertes, r.heridos, r.muertes_vulnerables, r.heridos_vulnerables) == (1, 1, 4, 1, 2)
    assert (r.HORARIO, r.vulnerables) == ("Nocturno 22-2", 2)


def test_zero_death_corridor_dropped(spark):
    d = dt.date(2020, 6, 1)
    acc = _acc(spark, [("A1", 7, d, "LUNES", 9, "SOLO DANOS"), ("A2", 8, d, "LUNES", 9, "CON MUERTOS")])
    kil = spark.createDataFrame([("A2", "CONDUCTOR")], "FORMULARIO string, CONDICION string")
    inj = spark.createDataFrame([], "FORMULARIO string, CONDICION string")
    grid = spark.createDataFrame([(1, 7, "AV UNO"), (2, 8, "AV DOS")], "pos long, CIV int, MVINOMBRE string")
    rows = build_features_from(acc, inj, kil, grid, "2020-12-31").collect()
    assert [(r.MVINOMBRE, r.muertes, r.vulnerables) for r in rows] == [("AV DOS", 1, 0)]
    # Window form and anti-join form agree
    from roadrisk.operators.joins import drop_zero_death_corridors, drop_zero_death_corridors_anti
    a6 = A.corridor_hour_totals(acc, inj, kil, grid, "2020-12-31")
    w = sorted(map(tuple, drop_zero_death_corridors(a6).collect()))
    assert w == sorted(map(tuple, drop_zero_death_corridors_anti(a6).select(*a6.columns).collect()))
    assert [r[0] for r in w] == ["AV DOS"]


def test_hour_block_and_severity(spark):
    df = spark.createDataFrame([(h,) for h in [0, 1, 2, 5, 8, 12, 18, 21, 22, 23, 24, None]], "h int")
    got = [r.b for r in df.select(hour_block(F.col("h")).alias("b")).collect()]
    assert got == ["Nocturno 22-2", "Nocturno 22-2", "Nocturno 2-5", "DiurnoMan 5-8", "DiurnoMan 8-12",
                   "DiurnoTarde 12-18", "NocturnoTarde 18-22", "NocturnoTarde 18-22", "Nocturno 22-2",
                   "Nocturno 22-2", None, None]
    sv = spark.createDataFrame([(0, 0), (0, 3), (1, 0), (2, 5)], "mv long, hv long")
    assert [r.s for r in sv.select(severity_index(F.col("mv"), F.col("hv")).alias("s")).collect()] == [0, 1, 2, 2]


def test_actor_states_final_state(spark):
    # ESTADO null -> ILESO; MUERTO if ESTADO MUERTO or MUERTE_POSTERIOR S (null -> else).
    rows = [(e, m) for e in ["MUERTO", "HERIDO", "ILESO", None] for m in ["S", "N", None]]
    raw = spark.createDataFrame([(1, "A1", 1, None, None, None, None, e, m, None) for e, m in rows],
                                "OBJECTID long, FORMULARIO string, CODIGO_VICTIMA int, CODIGO_VEHICULO int, "
                                "CONDICION string, GENERO string, EDAD int, ESTADO string, "
                                "MUERTE_POSTERIOR string, FECHA_POSTERIOR_MUERTE long")
    out = [(r.ESTADO, r.MUERTE_POSTERIOR, r.ESTADO_FINAL, r.CODIGO_VEHICULO, r.CONDICION)
           for r in clean_actors(raw).collect()]
    for (e, m), (ce, cm, fin, cv, cond) in zip(rows, out):
        assert ce == (e or "ILESO") and cm == m and cv == 0 and cond == "SIN INFORMACION"
        assert fin == ("MUERTO" if (ce == "MUERTO" or m == "S") else ce)


def test_vehicle_and_cause_cleaning(spark):
    # F7 + T15: fills only the named string columns; padded value trimmed; OTRAS -> OTRA.
    v = spark.createDataFrame([(1, "A1", None, None, " SIN INFORMACION", None, None),
                               (2, "A1", 3, "BUS", "PUBLICO", "URBANO", "N")],
                              "OBJECTID long, FORMULARIO string, CODIGO_VEHICULO int, CLASE string, "
                              "SERVICIO string, MODALIDAD string, ENFUGA string")
    r = clean_vehicles(v).orderBy("OBJECTID").collect()
    assert (r[0].CODIGO_VEHICULO, r[0].CLASE, r[0].SERVICIO, r[0].MODALIDAD, r[0].ENFUGA) == \
        (1, "SIN INFORMACION", "SIN INFORMACION", "SIN INFORMACION", None)
    c = spark.createDataFrame([(1, "A1", 1, "0", "OTRAS", None, None)],
                              "OBJECTID long, FORMULARIO string, CODIGO_VEHICULO int, CODIGO_CAUSA string, "
                              "NOMBRE string, TIPO string, TIPO_CAUSA string")
    r = clean_causes(c).collect()[0]
    assert (r.NOMBRE, r.TIPO, r.TIPO_CAUSA, r.CODIGO_VEHICULO) == ("OTRA", "SIN ESTABLECER", "SIN ESTABLECER", 1)


def test_accident_cleaning_fills_civ(spark):
    raw = spark.createDataFrame([(1, "A000000001", "X", None, None, "CHOQUE", "SOLO DANOS", 0, -74.0, 4.5)],
                                "OBJECTID long, FORMULARIO string, LOCALIDAD string, CIV int, PK_CALZADA int, "
                                "CLASE_ACC string, GRAVEDAD string, FECHA_HORA_ACC long, x double, y double")
    r = clean_accidents(raw).collect()[0]
    assert (r.CIV, r.PK_CALZADA, r.LONGITUD, r.FECHA_ACC) == (0, 0, -74.0, dt.date(1969, 12, 31))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5, 1), (5, 3), (5, 5)], "a long, b long")
    got = [(r.a, r.b) for r in minmax_scale(df, ["a", "b"]).orderBy("b").collect()]
    assert got == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0)]


def test_previous_month_rolls_january(spark):
    df = spark.createDataFrame([(2022, 12), (2023, 1), (2022, 1)],
                               "ANO_OCURRENCIA_ACC int, MES_NRO_OCURRENCIA_ACC int")
    got = [tuple(r) for r in previous_month_filter(df, dt.date(2023, 1, 24)).collect()]
    assert got == [(2022, 12)]


def test_clamp_as_of(spark):
    req = spark.createDataFrame([(2020, 2, 31), (2021, 2, 29), (2021, 4, 31), (2017, 5, 1), (2023, 2, 1),
                                 (2023, 1, 15), (2022, 13, 1)], "year int, month int, day int")
    got = [(r.valid, r.as_of) for r in clamp_as_of(req).collect()]
    assert got == [(True, dt.date(2020, 2, 29)), (True, dt.date(2021, 2, 28)), (True, dt.date(2021, 4, 30)),
                   (False, None), (False, None), (True, dt.date(2023, 1, 15)), (False, None)]


def test_priority_map(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,)], "l int")
    got = [r.p for r in df.select(label_to_priority(F.col("l")).alias("p")).collect()]
    assert got == ["3 NA", "2 Complementario", "1 Priorizado", None]
