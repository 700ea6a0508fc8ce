"""Cleaning rules of the six layers (F2-F8) as column expressions.

Each ``clean_*`` takes a raw layer (see ``roadrisk.sources.adapter``) and returns the
stored-table form. No UDFs: fills are ``coalesce``, recodes are ``when``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.functions.calendar import derive_calendar
from roadrisk.schemas import (CAUSE_OTHER, CAUSE_OTHER_RAW, NO_INFO, NO_INFO_PADDED,
                              NOT_ESTABLISHED)


def _replace(df: DataFrame, exprs: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """One projection: listed columns replaced by SQL expressions, others kept (or renamed)."""
    rename = rename or {}
    cols = []
    for c in df.columns:
        if c in exprs:
            cols.append(f"{exprs[c]} AS `{rename.get(c, c)}`")
        else:
            cols.append(f"`{c}` AS `{rename.get(c, c)}`" if c in rename else f"`{c}`")
    return df.selectExpr(*cols)


def _fill(values: dict) -> dict[str, str]:
    return {c: f"coalesce(`{c}`, '{v}')" for c, v in values.items()}


_GEOMETRY = {"x": "LONGITUD", "y": "LATITUD"}


def clean_accidents(raw: DataFrame) -> DataFrame:
    """F1 + F2: calendar columns; CIV and PK_CALZADA null -> 0 as int."""
    df = _replace(raw, {"CIV": "CAST(coalesce(CIV, 0) AS INT)",
                        "PK_CALZADA": "CAST(coalesce(PK_CALZADA, 0) AS INT)"}, _GEOMETRY)
    return derive_calendar(df)


def clean_injured(raw: DataFrame) -> DataFrame:
    """F1 + F3: GENERO null -> SIN INFORMACION (EDAD is left as it is)."""
    return derive_calendar(_replace(raw, _fill({"GENERO": NO_INFO}), _GEOMETRY))


def clean_killed(raw: DataFrame) -> DataFrame:
    """F1 + F4: F3 plus MUERTE_POSTERIOR null -> 'N'; death date as a timestamp."""
    exprs = _fill({"GENERO": NO_INFO, "MUERTE_POSTERIOR": "N"})
    exprs["FECHA_POSTERIOR_MUERTE"] = "timestamp_millis(CAST(FECHA_POSTERIOR_MUERTE AS BIGINT))"
    return derive_calendar(_replace(raw, exprs, _GEOMETRY))


FINAL_STATE_SQL = ("CASE WHEN ESTADO = 'MUERTO' OR MUERTE_POSTERIOR = 'S' THEN 'MUERTO' "
                   "ELSE ESTADO END")


def final_state():
    """MUERTO when ESTADO = MUERTO or MUERTE_POSTERIOR = 'S', else ESTADO.
    A null comparison falls to the ``ELSE`` branch."""
    return F.expr(FINAL_STATE_SQL)


def clean_actors(raw: DataFrame) -> DataFrame:
    """F5 + F6."""
    exprs = _fill({"GENERO": NO_INFO, "CONDICION": NO_INFO, "ESTADO": "ILESO"})
    exprs["CODIGO_VEHICULO"] = "CAST(coalesce(CODIGO_VEHICULO, 0) AS INT)"
    exprs["FECHA_POSTERIOR_MUERTE"] = "timestamp_millis(CAST(FECHA_POSTERIOR_MUERTE AS BIGINT))"
    return _replace(raw, exprs).selectExpr("*", f"{FINAL_STATE_SQL} AS ESTADO_FINAL")


def clean_vehicles(raw: DataFrame) -> DataFrame:
    """CODIGO_VEHICULO null -> 1; CLASE/SERVICIO/MODALIDAD null -> SIN INFORMACION;
    the padded ' SIN INFORMACION' is trimmed."""
    exprs = _fill({"CLASE": NO_INFO, "MODALIDAD": NO_INFO})
    exprs["CODIGO_VEHICULO"] = "CAST(coalesce(CODIGO_VEHICULO, 1) AS INT)"
    exprs["SERVICIO"] = (f"CASE WHEN coalesce(SERVICIO, '{NO_INFO}') = '{NO_INFO_PADDED}' THEN '{NO_INFO}' "
                         f"ELSE coalesce(SERVICIO, '{NO_INFO}') END")
    return _replace(raw, exprs)


def clean_causes(raw: DataFrame) -> DataFrame:
    """F8: string nulls -> SIN ESTABLECER; NOMBRE 'OTRAS' -> 'OTRA'."""
    exprs = _fill({c: NOT_ESTABLISHED for c in ("CODIGO_CAUSA", "TIPO", "TIPO_CAUSA")})
    exprs["NOMBRE"] = (f"CASE WHEN coalesce(NOMBRE, '{NOT_ESTABLISHED}') = '{CAUSE_OTHER_RAW}' "
                       f"THEN '{CAUSE_OTHER}' ELSE coalesce(NOMBRE, '{NOT_ESTABLISHED}') END")
    return _replace(raw, exprs)


CLEANERS = {
    "siniestros": clean_accidents,
    "conheridos": clean_injured,
    "confallecidos": clean_killed,
    "vehiculos": clean_vehicles,
    "actores": clean_actors,
    "causas": clean_causes,
}
