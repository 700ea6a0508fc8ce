"""M1 from stored month cells: a report reads the sums of whole months and only the window's
first and last month row by row.

The cells of a month are the five measures per (CIV, hour) of its accidents. As child rows lie
in their accident's month, a month's cells depend on that month's partitions alone. They are
kept beside the store's tables (``_cells``), one partition a month; whoever changes a month
drops its cells before the change shows (``drop_cells``, called by appends and by
``plans.commit``), and ``refresh_cells`` computes what is missing. A month without cells, also
one that was changed a moment ago, is read row by row, so a report is right whether or not the
cells are fresh. Cells don't depend on the corridor grid or on a report's date.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions.calendar import as_date, in_window, window_start
from roadrisk.operators import aggregates as A
from roadrisk.operators.filters import valid_corridor
from roadrisk.plans.commit import CELLS, PARTITIONS, Month, folders_of, in_months
from roadrisk.plans.features import features_of_cells
from roadrisk.plans.load import read_store

CELL_KEY = ["CIV", A.HORA]
CELL_SCHEMA = (f"CIV int, {A.HORA} int, " + ", ".join(f"{c} long" for c in A.MEASURES) + ", part_year int, part_month int")


def _cells_of(tables: dict[str, DataFrame], accidents: DataFrame, months: list[Month]) -> DataFrame:
    """Measures per (CIV, hour, month) of the given accidents, which lie in ``months``."""
    acc = A._not_null(valid_corridor(accidents), [A.DIA, A.HORA]).select("FORMULARIO", *A.CELL, "GRAVEDAD", *PARTITIONS)
    kids = [tables[c].where(in_months(months)) for c in ("conheridos", "confallecidos")]
    return A.cell_totals(A.measures_of(acc, *kids, [*A.CELL, *PARTITIONS]), [*CELL_KEY, *PARTITIONS])


def refresh_cells(spark: SparkSession, store_dir: str) -> list[Month]:
    """Compute the cells of the months that have none; returns these months."""
    have = folders_of(spark, f"{store_dir.rstrip('/')}/{CELLS}")
    missing = sorted((m for m in folders_of(spark, f"{store_dir.rstrip('/')}/siniestros") if None not in m and m not in have), key=str)
    if missing:
        tables = read_store(spark, store_dir, partitions=True)
        cells = _cells_of(tables, tables["siniestros"].where(in_months(missing)), missing)
        # months are new to this table, so nothing is overwritten
        cells.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(f"{store_dir.rstrip('/')}/{CELLS}")
    return missing


def _months(start: dt.date, end: dt.date) -> tuple[list[Month], list[Month]]:
    """(whole months, first and last month cut by the bounds) of the window after ``start`` up to ``end``."""
    first, whole, cut = start + dt.timedelta(days=1), [], []
    y, m = first.year, first.month
    while (y, m) <= (end.year, end.month):
        last = (dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1))
        (whole if dt.date(y, m, 1) >= first and last <= end else cut).append((y, m))
        y, m = y + m // 12, m % 12 + 1
    return whole, cut


def window_cells(spark: SparkSession, store_dir: str, end, years: int = 3) -> DataFrame:
    """Measures per (CIV, hour) of the window that ends at ``end``."""
    end = as_date(end)
    whole, cut = _months(window_start(end, years), end)
    have = folders_of(spark, f"{store_dir.rstrip('/')}/{CELLS}")
    stored = folders_of(spark, f"{store_dir.rstrip('/')}/siniestros")
    ready, raw = [m for m in whole if m in have], [m for m in [*whole, *cut] if m not in have or m in cut]
    raw = [m for m in raw if m in stored]
    parts = []
    if ready:
        parts.append(spark.read.schema(CELL_SCHEMA).parquet(f"{store_dir.rstrip('/')}/{CELLS}").where(in_months(ready)).select(*CELL_KEY, *A.MEASURES))
    if raw or not parts:
        tables = read_store(spark, store_dir, partitions=True)
        rows = tables["siniestros"].where(in_months(raw) & in_window(F.col("FECHA_ACC"), end, years))
        parts.append(_cells_of(tables, rows, raw).select(*CELL_KEY, *A.MEASURES))
    return reduce(DataFrame.union, parts).groupBy(*CELL_KEY).agg(*A._sums())


def build_features(spark: SparkSession, store_dir: str, grid: DataFrame, end, years: int = 3) -> DataFrame:
    """M1 of a store from its month cells."""
    return features_of_cells(window_cells(spark, store_dir, end, years), grid)
