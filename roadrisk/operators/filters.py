"""Projections and predicates (P1-P7). All are plain ``filter``/``select`` so Catalyst can
push them into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.functions.calendar import in_window, previous_month_filter  # noqa: F401 (P8)
from roadrisk.schemas import MOTORCYCLE, SEVERITY_INJURED, VULNERABLE_CONDITIONS


def rolling_window(df: DataFrame, end, years: int = 3, date_col: str = "FECHA_ACC") -> DataFrame:
    """Half-open window ``end - years < date <= end``."""
    return df.filter(in_window(F.col(date_col), end, years))


def valid_corridor(df: DataFrame, col: str = "CIV") -> DataFrame:
    """Drop rows without a usable corridor id (null or the 0 sentinel)."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != 0))


def severity_filter(df: DataFrame, severity: str = SEVERITY_INJURED) -> DataFrame:
    """Accidents of one severity label."""
    return df.filter(F.col("GRAVEDAD") == severity)


def is_vulnerable(col: str = "CONDICION"):
    """P4 predicate: pedestrian, cyclist or motorcyclist."""
    return F.col(col).isin(VULNERABLE_CONDITIONS)


def vulnerable_actor(df: DataFrame, col: str = "CONDICION") -> DataFrame:
    return df.filter(is_vulnerable(col))


def vehicle_class(df: DataFrame, cls: str = MOTORCYCLE, negate: bool = False,
                  col: str = "CLASE") -> DataFrame:
    """P5: LIKE without wildcards is equality; NOT LIKE also drops nulls (SQL semantics)."""
    return df.filter(F.col(col) != cls if negate else F.col(col) == cls)


def project(df: DataFrame, columns: list[str] | None = None, rename: dict | None = None,
            drop: list[str] | None = None, upper: bool = False) -> DataFrame:
    """Column subset, renames, dropped technical columns, optional upper-case names."""
    if columns:
        df = df.select(*columns)
    if rename:
        df = df.withColumnsRenamed(rename)
    if drop:
        df = df.drop(*drop)
    if upper:
        df = df.toDF(*[c.upper() for c in df.columns])
    return df


def named_corridor(df: DataFrame, col: str = "MVINOMBRE") -> DataFrame:
    """Keep corridors that have a name."""
    return df.filter(F.col(col).isNotNull())
