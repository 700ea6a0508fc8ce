"""Calendar rules: local-time derivation (F1), rolling windows (P1), previous month (P8),
request clamping (F13).

Local time is UTC - 5 h (fixed offset). The derivation works on epoch milliseconds with
integer arithmetic, so it gives the same answer whatever the session time zone is.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadrisk.schemas import DAY_NAMES, MONTH_NAMES, UTC_OFFSET_HOURS

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def _sql_array(values) -> str:
    return "array(" + ", ".join("'" + v + "'" for v in values) + ")"


def derive_calendar(df: DataFrame, ms_col: str = "FECHA_HORA_ACC", drop_source: bool = True) -> DataFrame:
    """epoch ms (UTC) -> local date, year, month (number, name), weekday (1=Mon, name),
    day of month and hour.

    Two projections: the local date and hour first, then the parts read from the date, so
    the epoch arithmetic is evaluated once per row.
    """
    lm = f"(`{ms_col}` + ({UTC_OFFSET_HOURS * HOUR_MS}L))"
    out = df.selectExpr(
        "*",
        f"date_from_unix_date(CAST(floor({lm} / {DAY_MS}D) AS INT)) AS FECHA_ACC",
        f"CAST(floor(pmod({lm}, {DAY_MS}L) / {HOUR_MS}D) AS INT) AS HORA_OCURRENCIA_ACC",
    ).selectExpr(
        "*",
        "year(FECHA_ACC) AS ANO_OCURRENCIA_ACC",
        f"element_at({_sql_array(MONTH_NAMES)}, month(FECHA_ACC)) AS MES_OCURRENCIA_ACC",
        "month(FECHA_ACC) AS MES_NRO_OCURRENCIA_ACC",
        f"element_at({_sql_array(DAY_NAMES)}, weekday(FECHA_ACC) + 1) AS DIA_OCURRENCIA_ACC",
        "weekday(FECHA_ACC) + 1 AS DIA_NRO_OCURRENCIA_ACC",
        "dayofmonth(FECHA_ACC) AS DIA_MES_OCURRENCIA_ACC",
    )
    return out.drop(ms_col) if drop_source else out


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def window_bounds(end, years: int = 3) -> tuple[Column, Column]:
    """(exclusive start, inclusive end) of the half-open rolling window ending at ``end``.

    ``add_months(end, -12*years)`` maps Feb 29 to Feb 28, as a calendar year offset does.
    """
    e = F.lit(as_date(end))
    return F.add_months(e, -12 * years), e


def in_window(date_col: Column, end, years: int = 3) -> Column:
    """P1 predicate: start < date <= end."""
    start, e = window_bounds(end, years)
    return (date_col > start) & (date_col <= e)


def window_start(end, years: int = 3) -> _dt.date:
    """Driver-side twin of ``add_months(end, -12*years)`` (for literal SQL text)."""
    e = as_date(end)
    y = e.year - years
    try:
        return e.replace(year=y)
    except ValueError:  # Feb 29 -> Feb 28
        return e.replace(year=y, day=28)


def previous_month(today) -> tuple[int, int, str]:
    """P8 (driver-side scalar): (year, month, month name) of the month before ``today``."""
    t = as_date(today)
    first = t.replace(day=1) - _dt.timedelta(days=1)
    return first.year, first.month, MONTH_NAMES[first.month - 1]


def previous_month_filter(df: DataFrame, today) -> DataFrame:
    """Rows of the calendar month before ``today`` (January rolls to December)."""
    prev = F.trunc(F.add_months(F.lit(as_date(today)), -1), "MM")
    return df.filter((F.col("ANO_OCURRENCIA_ACC") == F.year(prev))
                     & (F.col("MES_NRO_OCURRENCIA_ACC") == F.month(prev)))


def clamp_as_of(requests: DataFrame, horizon=(2023, 1), min_year: int = 2018,
                max_year: int = 2023) -> DataFrame:
    """validate (year, month, day) requests and clamp the day to the month end.

    Adds ``valid`` (ranges ok and not past the data horizon) and ``as_of`` (the clamped date,
    null when invalid).
    """
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    hy, hm = horizon
    in_range = (y.between(min_year, max_year) & m.between(1, 12) & d.between(1, 31))
    past_horizon = (y > hy) | ((y == hy) & (m > hm))
    valid = in_range & ~past_horizon
    last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return requests.withColumns({
        "valid": valid,
        "as_of": F.when(valid, F.make_date(y, m, F.least(d, last))),
    })
