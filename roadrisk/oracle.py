"""DuckDB SQL text of the adapter and clean views, used to build the oracle queries.
Death dates stay epoch milliseconds here (a timestamp in Spark's tables).

The oracle is an independent formulation: it follows the reference's SQL shapes (joins
then ``COUNT .. FILTER``, CTEs, ``GROUP BY``/``HAVING``), not the Spark plans. Views are
emitted as CTEs in dependency order, so each oracle query is one self-contained statement
over the driver's tables.
"""

from __future__ import annotations

from roadrisk.schemas import DAY_NAMES, HOUR_BLOCKS, MONTH_NAMES


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _form(col: str) -> str:
    s = f"CAST({col} AS VARCHAR)"
    return f"('A' || CASE WHEN length({s}) >= 9 THEN {s} ELSE lpad({s}, 9, '0') END)"


_CLASE_ACC = ("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ATROPELLO' WHEN '2' THEN 'CHOQUE' "
              "WHEN '3' THEN 'VOLCAMIENTO' WHEN '4' THEN 'CAIDA DE OCUPANTE' WHEN '5' THEN 'OTRO' END")
_TIME = "(epoch_ms(o_orderdate) + ((o_orderkey * 7) % 24 + 5) * 3600000)"
_GEOM = ("-74.0 - CAST(o_custkey % 100 AS DOUBLE) / 1000.0 AS x, "
         "4.5 + CAST(o_custkey % 70 AS DOUBLE) / 1000.0 AS y")
_COND = "(['PEATON', 'CICLISTA', 'MOTOCICLISTA', 'CONDUCTOR', 'PASAJERO'])[l_suppkey % 5 + 1]"
_GENERO = ("CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'FEMENINO' "
           "ELSE 'MASCULINO' END")
_EDAD = "CAST(CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_partkey % 90 END AS INTEGER)"

_CALENDAR = f"""
    CAST(lt AS DATE) AS FECHA_ACC,
    CAST(year(lt) AS INTEGER) AS ANO_OCURRENCIA_ACC,
    ({_list(MONTH_NAMES)})[month(lt)] AS MES_OCURRENCIA_ACC,
    CAST(month(lt) AS INTEGER) AS MES_NRO_OCURRENCIA_ACC,
    ({_list(DAY_NAMES)})[isodow(lt)] AS DIA_OCURRENCIA_ACC,
    CAST(isodow(lt) AS INTEGER) AS DIA_NRO_OCURRENCIA_ACC,
    CAST(day(lt) AS INTEGER) AS DIA_MES_OCURRENCIA_ACC,
    CAST(hour(lt) AS INTEGER) AS HORA_OCURRENCIA_ACC"""

_PERSON = f"""
    l_orderkey * 8 + l_linenumber AS OBJECTID, {_form('l_orderkey')} AS FORMULARIO,
    CAST(NULL AS VARCHAR) AS LOCALIDAD, {_CLASE_ACC} AS CLASE_ACC, {_COND} AS CONDICION,
    {_GENERO} AS GENERO, {_EDAD} AS EDAD"""

HOUR_BLOCK_SQL = "(" + _list([HOUR_BLOCKS[h] for h in range(24)]) + ")[{h} + 1]"

VIEWS: dict[str, tuple[list[str], str]] = {
    "siniestros_raw": ([], f"""
SELECT o_orderkey AS OBJECTID, {_form('o_orderkey')} AS FORMULARIO, n_name AS LOCALIDAD,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS INTEGER) AS CIV,
    CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 50 END AS INTEGER) AS PK_CALZADA,
    {_CLASE_ACC} AS CLASE_ACC,
    CASE o_orderstatus WHEN 'F' THEN 'CON MUERTOS' WHEN 'O' THEN 'CON HERIDOS'
        WHEN 'P' THEN 'SOLO DANOS' END AS GRAVEDAD,
    {_TIME} AS FECHA_HORA_ACC, {_GEOM}
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "siniestros": (["siniestros_raw"], f"""
SELECT OBJECTID, FORMULARIO, LOCALIDAD, CAST(coalesce(CIV, 0) AS INTEGER) AS CIV,
    CAST(coalesce(PK_CALZADA, 0) AS INTEGER) AS PK_CALZADA, CLASE_ACC, GRAVEDAD,
    x AS LONGITUD, y AS LATITUD, {_CALENDAR}
FROM (SELECT *, epoch_ms(FECHA_HORA_ACC - 18000000) AS lt FROM siniestros_raw)"""),
    "person_base": ([], """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag,
    o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "conheridos_raw": (["person_base"], f"""
SELECT {_PERSON}, {_TIME} AS FECHA_HORA_ACC, {_GEOM}
FROM person_base WHERE l_returnflag = 'R' AND o_orderstatus IN ('F', 'O')"""),
    "conheridos": (["conheridos_raw"], f"""
SELECT OBJECTID, FORMULARIO, LOCALIDAD, CLASE_ACC, CONDICION,
    coalesce(GENERO, 'SIN INFORMACION') AS GENERO, EDAD, x AS LONGITUD, y AS LATITUD, {_CALENDAR}
FROM (SELECT *, epoch_ms(FECHA_HORA_ACC - 18000000) AS lt FROM conheridos_raw)"""),
    "confallecidos_raw": (["person_base"], f"""
SELECT {_PERSON},
    CASE l_partkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END AS MUERTE_POSTERIOR,
    CAST(CASE WHEN l_partkey % 3 = 0 THEN {_TIME} + (l_partkey % 20) * 86400000 END AS BIGINT) AS FECHA_POSTERIOR_MUERTE,
    {_TIME} AS FECHA_HORA_ACC, {_GEOM}
FROM person_base
WHERE l_returnflag = 'A' AND ((l_quantity >= 49 AND o_orderstatus = 'F')
    OR (l_quantity = 50 AND l_suppkey % 10 = 0 AND o_orderstatus = 'O'))"""),
    "confallecidos": (["confallecidos_raw"], f"""
SELECT OBJECTID, FORMULARIO, LOCALIDAD, CLASE_ACC, CONDICION,
    coalesce(GENERO, 'SIN INFORMACION') AS GENERO, EDAD,
    coalesce(MUERTE_POSTERIOR, 'N') AS MUERTE_POSTERIOR, FECHA_POSTERIOR_MUERTE,
    x AS LONGITUD, y AS LATITUD, {_CALENDAR}
FROM (SELECT *, epoch_ms(FECHA_HORA_ACC - 18000000) AS lt FROM confallecidos_raw)"""),
    "vehiculos_raw": ([], f"""
SELECT l_orderkey * 8 + l_linenumber AS OBJECTID, {_form('l_orderkey')} AS FORMULARIO,
    CAST(CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_linenumber END AS INTEGER) AS CODIGO_VEHICULO,
    CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'MOTOCICLETA' WHEN 'PROMO' THEN 'AUTOMOVIL'
        WHEN 'ECONOMY' THEN 'CAMIONETA' WHEN 'MEDIUM' THEN 'BUS' WHEN 'SMALL' THEN 'BICICLETA' END AS CLASE,
    CASE WHEN l_suppkey % 19 = 0 THEN NULL
        ELSE CASE l_returnflag WHEN 'A' THEN 'PARTICULAR' WHEN 'N' THEN 'PUBLICO'
            WHEN 'R' THEN ' SIN INFORMACION' END END AS SERVICIO,
    CASE WHEN l_suppkey % 7 = 0 THEN 'URBANO' END AS MODALIDAD,
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE 'N' END AS ENFUGA
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""),
    "vehiculos": (["vehiculos_raw"], """
SELECT OBJECTID, FORMULARIO, CAST(coalesce(CODIGO_VEHICULO, 1) AS INTEGER) AS CODIGO_VEHICULO,
    coalesce(CLASE, 'SIN INFORMACION') AS CLASE,
    CASE WHEN coalesce(SERVICIO, 'SIN INFORMACION') = ' SIN INFORMACION' THEN 'SIN INFORMACION'
        ELSE coalesce(SERVICIO, 'SIN INFORMACION') END AS SERVICIO,
    coalesce(MODALIDAD, 'SIN INFORMACION') AS MODALIDAD, ENFUGA
FROM vehiculos_raw"""),
    "actores_raw": ([], f"""
SELECT l_orderkey * 8 + l_linenumber AS OBJECTID, {_form('l_orderkey')} AS FORMULARIO,
    CAST(l_linenumber AS INTEGER) AS CODIGO_VICTIMA,
    CAST(CASE WHEN cond IS NULL OR cond IN ('PEATON', 'PASAJERO') THEN NULL ELSE l_linenumber END
        AS INTEGER) AS CODIGO_VEHICULO,
    cond AS CONDICION, {_GENERO} AS GENERO, {_EDAD} AS EDAD,
    CASE WHEN l_partkey % 17 = 0 THEN NULL
        WHEN l_returnflag = 'A' AND l_quantity >= 49 THEN 'MUERTO'
        WHEN l_returnflag = 'R' THEN 'HERIDO' ELSE 'ILESO' END AS ESTADO,
    CASE WHEN l_partkey % 41 = 0 THEN 'S' WHEN l_partkey % 2 = 0 THEN NULL ELSE 'N' END
        AS MUERTE_POSTERIOR,
    CAST(CASE WHEN l_partkey % 41 = 0 THEN 946684800000 + (l_partkey % 365) * 86400000 END AS BIGINT) AS FECHA_POSTERIOR_MUERTE
FROM (SELECT *, CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE {_COND} END AS cond FROM lineitem)"""),
    "actores": (["actores_raw"], """
SELECT OBJECTID, FORMULARIO, CODIGO_VICTIMA, CAST(coalesce(CODIGO_VEHICULO, 0) AS INTEGER)
        AS CODIGO_VEHICULO,
    coalesce(CONDICION, 'SIN INFORMACION') AS CONDICION,
    coalesce(GENERO, 'SIN INFORMACION') AS GENERO, EDAD,
    coalesce(ESTADO, 'ILESO') AS ESTADO, MUERTE_POSTERIOR, FECHA_POSTERIOR_MUERTE,
    CASE WHEN coalesce(ESTADO, 'ILESO') = 'MUERTO' OR MUERTE_POSTERIOR = 'S' THEN 'MUERTO'
        ELSE coalesce(ESTADO, 'ILESO') END AS ESTADO_FINAL
FROM actores_raw"""),
    "causas_raw": ([], f"""
SELECT l_orderkey * 8 + l_linenumber AS OBJECTID, {_form('l_orderkey')} AS FORMULARIO,
    CAST(l_linenumber AS INTEGER) AS CODIGO_VEHICULO, CAST(l_partkey % 108 AS VARCHAR) AS CODIGO_CAUSA,
    CASE WHEN l_partkey % 108 = 0 THEN 'OTRAS' ELSE 'CAUSA ' || CAST(l_partkey % 108 AS VARCHAR) END
        AS NOMBRE,
    tipo AS TIPO,
    CASE tipo WHEN 'CE' THEN 'DEL CONDUCTOR' WHEN 'CG' THEN 'GENERAL' WHEN 'PA' THEN 'DEL PASAJERO'
        WHEN 'PE' THEN 'DEL PEATON' WHEN 'VI' THEN 'DE LA VIA' END AS TIPO_CAUSA
FROM (SELECT *, CASE WHEN l_partkey % 37 = 0 THEN NULL
        ELSE (['CE', 'CG', 'PA', 'PE', 'VI'])[l_partkey % 5 + 1] END AS tipo FROM lineitem)"""),
    "causas": (["causas_raw"], """
SELECT OBJECTID, FORMULARIO, CODIGO_VEHICULO,
    coalesce(CODIGO_CAUSA, 'SIN ESTABLECER') AS CODIGO_CAUSA,
    CASE WHEN coalesce(NOMBRE, 'SIN ESTABLECER') = 'OTRAS' THEN 'OTRA'
        ELSE coalesce(NOMBRE, 'SIN ESTABLECER') END AS NOMBRE,
    coalesce(TIPO, 'SIN ESTABLECER') AS TIPO, coalesce(TIPO_CAUSA, 'SIN ESTABLECER') AS TIPO_CAUSA
FROM causas_raw"""),
    "malla_raw": ([], """
SELECT c_custkey AS pos,
    CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS INTEGER) AS CIV,
    CASE WHEN c_custkey % 17 = 3 THEN NULL ELSE c_mktsegment || ' ' || n_name END AS MVINOMBRE
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "malla": (["malla_raw"], """
SELECT pos, CIV, MVINOMBRE FROM (
    SELECT *, row_number() OVER (PARTITION BY CIV ORDER BY pos) AS rn
    FROM malla_raw WHERE CIV IS NOT NULL)
WHERE rn = 1 AND MVINOMBRE IS NOT NULL"""),
}


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], body: str) -> str:
    """``WITH <views in dependency order> <body>``."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in _ordered(views))
    return f"WITH {ctes}\n{body}"


def window_sql(col: str, start, end) -> str:
    """Half-open window predicate on a DATE column, with literal bounds."""
    return f"{col} > DATE '{start}' AND {col} <= DATE '{end}'"


def hour_block_sql(h: str) -> str:
    return HOUR_BLOCK_SQL.format(h=h)
