"""Schemas and fixed values of the incident data model.

Everything under "FIXED VALUES" must equal the source data model for results to match;
it is stated plainly, in natural order, and shared by every operator and oracle.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source data model exactly)
# ---------------------------------------------------------------------------

# Month names, January .. December (upper case, Spanish).
MONTH_NAMES = [
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
]

# Weekday names, Monday .. Sunday (upper case, Spanish, accents kept). Day number 1 = Monday.
DAY_NAMES = ["LUNES", "MARTES", "MIÉRCOLES", "JUEVES", "VIERNES", "SÁBADO", "DOMINGO"]

# Hour of day (0..23) -> time block.
HOUR_BLOCKS = {
    0: "Nocturno 22-2", 1: "Nocturno 22-2",
    2: "Nocturno 2-5", 3: "Nocturno 2-5", 4: "Nocturno 2-5",
    5: "DiurnoMan 5-8", 6: "DiurnoMan 5-8", 7: "DiurnoMan 5-8",
    8: "DiurnoMan 8-12", 9: "DiurnoMan 8-12", 10: "DiurnoMan 8-12", 11: "DiurnoMan 8-12",
    12: "DiurnoTarde 12-18", 13: "DiurnoTarde 12-18", 14: "DiurnoTarde 12-18",
    15: "DiurnoTarde 12-18", 16: "DiurnoTarde 12-18", 17: "DiurnoTarde 12-18",
    18: "NocturnoTarde 18-22", 19: "NocturnoTarde 18-22", 20: "NocturnoTarde 18-22",
    21: "NocturnoTarde 18-22",
    22: "Nocturno 22-2", 23: "Nocturno 22-2",
}
# The six blocks in sorted order (fixed pivot / one-hot domain).
BLOCKS = sorted(set(HOUR_BLOCKS.values()))

# Cluster label -> priority text (default model mapping).
PRIORITY_MAP = {0: "3 NA", 1: "2 Complementario", 2: "1 Priorizado"}

# Road users counted as vulnerable.
VULNERABLE_CONDITIONS = ["PEATON", "CICLISTA", "MOTOCICLISTA"]

# Severity labels of an accident.
SEVERITY_INJURED = "CON HERIDOS"
SEVERITY_KILLED = "CON MUERTOS"
SEVERITY_DAMAGE = "SOLO DANOS"

# Vehicle class of a motorcycle.
MOTORCYCLE = "MOTOCICLETA"

# Fill values of the cleaning rules.
NO_INFO = "SIN INFORMACION"
NO_INFO_PADDED = " SIN INFORMACION"
NOT_ESTABLISHED = "SIN ESTABLECER"
CAUSE_OTHER_RAW = "OTRAS"
CAUSE_OTHER = "OTRA"

# Local time = UTC - 5 hours, fixed offset, no daylight saving.
UTC_OFFSET_HOURS = -5

# Declared VARCHAR(n) lengths of the stored tables.
VARCHAR_LIMITS = {
    "siniestros": {
        "FORMULARIO": 25, "LOCALIDAD": 50, "CLASE_ACC": 25, "GRAVEDAD": 25,
        "MES_OCURRENCIA_ACC": 25, "DIA_OCURRENCIA_ACC": 25,
    },
    "conheridos": {
        "FORMULARIO": 25, "LOCALIDAD": 50, "CLASE_ACC": 25, "CONDICION": 25, "GENERO": 25,
        "MES_OCURRENCIA_ACC": 25, "DIA_OCURRENCIA_ACC": 25,
    },
    "confallecidos": {
        "FORMULARIO": 25, "LOCALIDAD": 50, "CLASE_ACC": 25, "CONDICION": 25, "GENERO": 25,
        "MUERTE_POSTERIOR": 5, "MES_OCURRENCIA_ACC": 25, "DIA_OCURRENCIA_ACC": 25,
    },
    "vehiculos": {
        "FORMULARIO": 25, "CLASE": 25, "SERVICIO": 25, "MODALIDAD": 50, "ENFUGA": 5,
    },
    "actores": {
        "FORMULARIO": 25, "CONDICION": 25, "GENERO": 25, "ESTADO": 25,
        "MUERTE_POSTERIOR": 5, "ESTADO_FINAL": 25,
    },
    "causas": {
        "FORMULARIO": 25, "CODIGO_CAUSA": 10, "NOMBRE": 75, "TIPO": 25, "TIPO_CAUSA": 25,
    },
}

CHILD_TABLES = ["conheridos", "confallecidos", "vehiculos", "actores", "causas"]
ALL_TABLES = ["siniestros"] + CHILD_TABLES

# ---------------------------------------------------------------------------
# Column sets
# ---------------------------------------------------------------------------

CALENDAR_COLUMNS = [
    "FECHA_ACC", "ANO_OCURRENCIA_ACC", "MES_OCURRENCIA_ACC", "MES_NRO_OCURRENCIA_ACC",
    "DIA_OCURRENCIA_ACC", "DIA_NRO_OCURRENCIA_ACC", "DIA_MES_OCURRENCIA_ACC",
    "HORA_OCURRENCIA_ACC",
]

FEATURE_COLUMNS = [
    "MVINOMBRE", "HORARIO", "accidentes", "muertes", "heridos",
    "muertes_vulnerables", "heridos_vulnerables", "vulnerables",
]
NUMERIC_FEATURES = ["accidentes", "muertes", "heridos"]
CATEGORICAL_FEATURES = ["HORARIO", "vulnerables"]

# ---------------------------------------------------------------------------
# Raw layer schemas (one feature-service page: {features: [{attributes, geometry}]})
# ---------------------------------------------------------------------------

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _fields(*pairs):
    return [T.StructField(n, t, True) for n, t in pairs]


RAW_ATTRIBUTES = {
    "siniestros": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("LOCALIDAD", _S), ("CIV", _I), ("PK_CALZADA", _I),
        ("CLASE_ACC", _S), ("GRAVEDAD", _S), ("FECHA_HORA_ACC", _L)),
    "conheridos": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("LOCALIDAD", _S), ("CLASE_ACC", _S),
        ("CONDICION", _S), ("GENERO", _S), ("EDAD", _I), ("FECHA_HORA_ACC", _L)),
    "confallecidos": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("LOCALIDAD", _S), ("CLASE_ACC", _S),
        ("CONDICION", _S), ("GENERO", _S), ("EDAD", _I), ("MUERTE_POSTERIOR", _S),
        ("FECHA_POSTERIOR_MUERTE", _L), ("FECHA_HORA_ACC", _L)),
    "causas": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("CODIGO_VEHICULO", _I), ("CODIGO_CAUSA", _S),
        ("NOMBRE", _S), ("TIPO", _S), ("TIPO_CAUSA", _S)),
    "actores": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("CODIGO_VICTIMA", _I), ("CODIGO_VEHICULO", _I),
        ("CONDICION", _S), ("GENERO", _S), ("EDAD", _I), ("ESTADO", _S),
        ("MUERTE_POSTERIOR", _S), ("FECHA_POSTERIOR_MUERTE", _L)),
    "vehiculos": _fields(
        ("OBJECTID", _L), ("FORMULARIO", _S), ("CODIGO_VEHICULO", _I), ("CLASE", _S),
        ("SERVICIO", _S), ("MODALIDAD", _S), ("ENFUGA", _S)),
}

# Layers that carry point geometry.
GEOMETRY_LAYERS = {"siniestros", "conheridos", "confallecidos"}

GEOMETRY = T.StructType(_fields(("x", _D), ("y", _D)))


def feature_page_schema(layer: str) -> T.StructType:
    """Schema of one landed JSON page of a layer (explicit, no inference)."""
    feat = [T.StructField("attributes", T.StructType(RAW_ATTRIBUTES[layer]), True)]
    if layer in GEOMETRY_LAYERS:
        feat.append(T.StructField("geometry", GEOMETRY, True))
    return T.StructType([T.StructField("features", T.ArrayType(T.StructType(feat)), True)])


#: What a page can hold besides features: the service's error answer, and the text of a page
#: that doesn't fit the schema.
ERROR_FIELD, BAD_FIELD = "error", "_bad"


def checked_page_schema(layer: str) -> T.StructType:
    """The page schema with the service's error answer and the unreadable text."""
    return T.StructType([*feature_page_schema(layer).fields, T.StructField(ERROR_FIELD, _S, True),
                         T.StructField(BAD_FIELD, _S, True)])


GRID_PAGE_SCHEMA = T.StructType([
    T.StructField("type", _S, True),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", _S, True),
        T.StructField("properties", T.StructType(_fields(("MVICIV", _I), ("MVINOMBRE", _S))), True),
    ])), True),
])

FEATURE_CSV_SCHEMA = T.StructType(_fields(
    ("MVINOMBRE", _S), ("HORARIO", _S), ("accidentes", _L), ("muertes", _L), ("heridos", _L),
    ("muertes_vulnerables", _L), ("heridos_vulnerables", _L), ("vulnerables", _I)))
