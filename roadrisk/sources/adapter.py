"""Raw incident layers derived from the driver's star-schema Parquet tables.

Each function returns the *raw* layer (as landed from the feature service, nulls
included): attribute columns plus flattened geometry ``x``/``y`` where the layer has it.
The cleaning rules of ``roadrisk.functions.cleaning`` turn these into stored tables.

Mapping (fixed adapter rules):
  orders          -> accidents (one per order); customer/nation give corridor and locality
  lineitem+orders -> injured (returnflag R) and killed (returnflag A, large quantities)
  lineitem+part   -> vehicles;  lineitem -> actors, causes
  customer+nation -> corridor grid (with duplicate CIVs and unnamed segments)

All derivations are column expressions; the only joins are equi-joins on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES of the adapter (code -> label)
# ---------------------------------------------------------------------------
ACCIDENT_CLASS = {"1": "ATROPELLO", "2": "CHOQUE", "3": "VOLCAMIENTO",
                  "4": "CAIDA DE OCUPANTE", "5": "OTRO"}
SEVERITY_BY_STATUS = {"F": "CON MUERTOS", "O": "CON HERIDOS", "P": "SOLO DANOS"}
CONDITION_BY_MOD5 = ["PEATON", "CICLISTA", "MOTOCICLISTA", "CONDUCTOR", "PASAJERO"]
VEHICLE_CLASS_BY_TYPE = {"STANDARD": "MOTOCICLETA", "PROMO": "AUTOMOVIL", "ECONOMY": "CAMIONETA",
                         "MEDIUM": "BUS", "SMALL": "BICICLETA"}
SERVICE_BY_FLAG = {"A": "PARTICULAR", "N": "PUBLICO", "R": " SIN INFORMACION"}
CAUSE_TYPES = ["CE", "CG", "PA", "PE", "VI"]
CAUSE_TYPE_NAMES = {"CE": "DEL CONDUCTOR", "CG": "GENERAL", "PA": "DEL PASAJERO",
                    "PE": "DEL PEATON", "VI": "DE LA VIA"}
DAY_MS = 86_400_000
HOUR_MS = 3_600_000


_READERS: dict[str, tuple[SparkSession, DataFrame]] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reader of one driver table. The inputs are read-only, so one reader per session and
    path is reused (file listing and footer reads happen once, not once per query)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _READERS.get(path)
    if hit is None or hit[0] is not spark:
        _READERS[path] = (spark, spark.read.parquet(path))
    return _READERS[path][1]


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def sql_case(key: str, mapping: dict) -> str:
    """``CASE key WHEN k THEN v .. END`` (unmatched -> NULL)."""
    return "CASE " + key + " " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items()) + " END"


def sql_array(values) -> str:
    return "array(" + ", ".join("NULL" if v is None else _q(v) for v in values) + ")"


def formulario_sql(key: str) -> str:
    """Accident form id: 'A' + key zero-padded to at least 9 digits (never truncated)."""
    s = f"CAST({key} AS STRING)"
    return f"concat('A', CASE WHEN length({s}) >= 9 THEN {s} ELSE lpad({s}, 9, '0') END)"


def accident_time_sql(orderkey: str = "o_orderkey", orderdate: str = "o_orderdate") -> str:
    """Epoch ms of (order date + ((key*7) % 24 + 5) hours), built from the calendar day and
    time of day so that it does not depend on the session time zone."""
    return (f"CAST(unix_date(to_date({orderdate})) AS BIGINT) * {DAY_MS}L"
            f" + CAST(hour({orderdate}) * 3600 + minute({orderdate}) * 60 + second({orderdate}) AS BIGINT) * 1000L"
            f" + CAST(({orderkey} * 7) % 24 + 5 AS BIGINT) * {HOUR_MS}L")


GEOMETRY_SQL = ["-74.0D - (o_custkey % 100) / 1000.0D AS x", "4.5D + (o_custkey % 70) / 1000.0D AS y"]
CLASE_ACC_SQL = sql_case("substring(o_orderpriority, 1, 1)", ACCIDENT_CLASS)
CONDITION_SQL = f"element_at({sql_array(CONDITION_BY_MOD5)}, CAST(l_suppkey % 5 AS INT) + 1)"
GENDER_SQL = ("CASE WHEN l_partkey % 11 = 0 THEN CAST(NULL AS STRING) "
              "WHEN l_partkey % 2 = 0 THEN 'FEMENINO' ELSE 'MASCULINO' END")
AGE_SQL = "CAST(CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_partkey % 90 END AS INT)"


def accidents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # One row per customer key, stated with a groupBy: a query that never reads LOCALIDAD
    # then drops this left join altogether (Spark removes an outer join whose other side
    # is unique on the key and unused); one that reads it shuffles customers once, the
    # same exchange the join would need.
    loc = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
           .groupBy("c_custkey").agg(F.max("n_name").alias("n_name")))
    return o.join(loc, o.o_custkey == loc.c_custkey, "left").selectExpr(
        "o_orderkey AS OBJECTID",
        f"{formulario_sql('o_orderkey')} AS FORMULARIO",
        "n_name AS LOCALIDAD",
        "CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS INT) AS CIV",
        "CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 50 END AS INT) AS PK_CALZADA",
        f"{CLASE_ACC_SQL} AS CLASE_ACC",
        f"{sql_case('o_orderstatus', SEVERITY_BY_STATUS)} AS GRAVEDAD",
        f"{accident_time_sql()} AS FECHA_HORA_ACC",
        *GEOMETRY_SQL)


#: Every child layer is a *source* (its join key and the few table columns it is made of) and a
#: *layer* of it (its wide text columns, by expressions alone), so a load can move source rows and
#: make the layer where it is written. Of a key that a layer only reads by remainders, the source
#: holds a remainder that gives them all.
LINE_SQL = ["l_orderkey * 8 + l_linenumber AS OBJECTID", f"{formulario_sql('l_orderkey')} AS FORMULARIO"]
CARRIED = ["part_year", "part_month", "page"]


def _layer(source: DataFrame, exprs: list[str]) -> DataFrame:
    """The layer of source rows; partition and page columns that they carry stay."""
    return source.selectExpr(*exprs, *[c for c in CARRIED if c in source.columns])


def _persons(spark: SparkSession, sf_dir: str, line_filter: str, order_filter: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return li.filter(line_filter).join(o.filter(order_filter), li.l_orderkey == o.o_orderkey)


PERSON_SQL = [
    "OBJECTID", "FORMULARIO",
    "CAST(NULL AS STRING) AS LOCALIDAD",
    f"{CLASE_ACC_SQL} AS CLASE_ACC",
    f"{CONDITION_SQL} AS CONDICION",
    f"{GENDER_SQL} AS GENERO",
    f"{AGE_SQL} AS EDAD",
]


PERSON_SOURCE_SQL = [*LINE_SQL, "l_partkey", "l_suppkey % 5 AS l_suppkey", "o_custkey % 700 AS o_custkey", "substring(o_orderpriority, 1, 1) AS o_orderpriority",
                     f"{accident_time_sql()} AS FECHA_HORA_ACC"]


def injured_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _persons(spark, sf_dir, "l_returnflag = 'R'", "o_orderstatus IN ('F', 'O')").selectExpr(*PERSON_SOURCE_SQL)


def injured_layer(source: DataFrame) -> DataFrame:
    return _layer(source, [*PERSON_SQL, "FECHA_HORA_ACC", *GEOMETRY_SQL])


def killed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _persons(spark, sf_dir, "l_returnflag = 'A' AND l_quantity >= 49", "o_orderstatus IN ('F', 'O')")
    j = j.filter("(l_quantity >= 49 AND o_orderstatus = 'F') OR "
                 "(l_quantity = 50 AND l_suppkey % 10 = 0 AND o_orderstatus = 'O')")
    return j.selectExpr(*PERSON_SOURCE_SQL)


def killed_layer(source: DataFrame) -> DataFrame:
    return _layer(source, [
        *PERSON_SQL,
        "CASE l_partkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END AS MUERTE_POSTERIOR",
        "CASE WHEN l_partkey % 3 = 0 THEN FECHA_HORA_ACC + (l_partkey % 20) * 86400000 END AS FECHA_POSTERIOR_MUERTE",
        "FECHA_HORA_ACC", *GEOMETRY_SQL])


def vehicles_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    # One row per part key (see accidents_raw): queries that never read CLASE skip the join.
    p = _read(spark, sf_dir, "part").groupBy("p_partkey").agg(F.max("p_type").alias("p_type"))
    return li.join(p, li.l_partkey == p.p_partkey, "left").selectExpr(
        *LINE_SQL, "l_linenumber", "l_partkey % (31 * 101) AS l_partkey", "l_suppkey % (19 * 7) AS l_suppkey", "l_returnflag",
        f"array_position({sql_array(VEHICLE_CLASS_BY_TYPE)}, split(p_type, chr(32))[0]) AS p_type")


def vehicles_layer(source: DataFrame) -> DataFrame:
    return _layer(source, [
        "OBJECTID", "FORMULARIO",
        "CAST(CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_linenumber END AS INT) AS CODIGO_VEHICULO",
        f"element_at({sql_array([None, *VEHICLE_CLASS_BY_TYPE.values()])}, CAST(p_type + 1 AS INT)) AS CLASE",
        f"CASE WHEN l_suppkey % 19 = 0 THEN CAST(NULL AS STRING) "
        f"ELSE {sql_case('l_returnflag', SERVICE_BY_FLAG)} END AS SERVICIO",
        "CASE WHEN l_suppkey % 7 = 0 THEN 'URBANO' END AS MODALIDAD",
        "CASE WHEN l_partkey % 101 = 0 THEN CAST(NULL AS STRING) ELSE 'N' END AS ENFUGA"])


def actors_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    return li.selectExpr(*LINE_SQL, "l_linenumber", "l_partkey", "l_suppkey % 5 AS l_suppkey", "l_quantity >= 49 AS large", "l_returnflag")


def actors_layer(source: DataFrame) -> DataFrame:
    cond = f"CASE WHEN l_partkey % 23 = 0 THEN CAST(NULL AS STRING) ELSE {CONDITION_SQL} END"
    return _layer(source.selectExpr("*", f"{cond} AS _cond"), [
        "OBJECTID", "FORMULARIO",
        "CAST(l_linenumber AS INT) AS CODIGO_VICTIMA",
        "CAST(CASE WHEN _cond IS NULL OR _cond IN ('PEATON', 'PASAJERO') THEN NULL "
        "ELSE l_linenumber END AS INT) AS CODIGO_VEHICULO",
        "_cond AS CONDICION",
        f"{GENDER_SQL} AS GENERO",
        f"{AGE_SQL} AS EDAD",
        "CASE WHEN l_partkey % 17 = 0 THEN CAST(NULL AS STRING) "
        "WHEN l_returnflag = 'A' AND large THEN 'MUERTO' "
        "WHEN l_returnflag = 'R' THEN 'HERIDO' ELSE 'ILESO' END AS ESTADO",
        "CASE WHEN l_partkey % 41 = 0 THEN 'S' WHEN l_partkey % 2 = 0 THEN CAST(NULL AS STRING) "
        "ELSE 'N' END AS MUERTE_POSTERIOR",
        "CASE WHEN l_partkey % 41 = 0 THEN 946684800000 + (l_partkey % 365) * 86400000 END AS FECHA_POSTERIOR_MUERTE"])


def causes_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return li.selectExpr(*LINE_SQL, "l_linenumber", "l_partkey")


def causes_layer(source: DataFrame) -> DataFrame:
    tipo = (f"CASE WHEN l_partkey % 37 = 0 THEN CAST(NULL AS STRING) "
            f"ELSE element_at({sql_array(CAUSE_TYPES)}, CAST(l_partkey % 5 AS INT) + 1) END")
    return _layer(source.selectExpr("*", "CAST(l_partkey % 108 AS STRING) AS _code", f"{tipo} AS _tipo"), [
        "OBJECTID", "FORMULARIO",
        "CAST(l_linenumber AS INT) AS CODIGO_VEHICULO",
        "_code AS CODIGO_CAUSA",
        "CASE WHEN _code = '0' THEN 'OTRAS' ELSE concat('CAUSA ', _code) END AS NOMBRE",
        "_tipo AS TIPO",
        f"{sql_case('_tipo', CAUSE_TYPE_NAMES)} AS TIPO_CAUSA"])


def grid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corridor grid segments in file order: (pos, CIV, MVINOMBRE)."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").selectExpr(
        "c_custkey AS pos",
        "CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS INT) AS CIV",
        "CASE WHEN c_custkey % 17 = 3 THEN CAST(NULL AS STRING) "
        "ELSE concat(c_mktsegment, ' ', n_name) END AS MVINOMBRE")


CHILD_LAYERS = {
    "conheridos": (injured_source, injured_layer),
    "confallecidos": (killed_source, killed_layer),
    "vehiculos": (vehicles_source, vehicles_layer),
    "actores": (actors_source, actors_layer),
    "causas": (causes_source, causes_layer),
}


def _child_raw(name: str):
    source, layer = CHILD_LAYERS[name]
    return lambda spark, sf_dir: layer(source(spark, sf_dir))


RAW_LAYERS = {"siniestros": accidents_raw, **{name: _child_raw(name) for name in CHILD_LAYERS}}
