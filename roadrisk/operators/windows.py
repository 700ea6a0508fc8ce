"""De-duplication, ordering, previews and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_grid(grid: DataFrame, key: str = "CIV", order: str = "pos") -> DataFrame:
    """Keep the first segment per CIV in file order, *before* any name check.

    Written as an aggregate (``min`` of a struct led by the file position) rather than a
    ``row_number`` window: the aggregate combines map-side, so a CIV that owns a third of
    the grid is reduced before the shuffle instead of landing whole in one task.
    """
    others = [c for c in grid.columns if c not in (key, order)]
    first = F.min(F.struct(F.col(order), *[F.col(c) for c in others])).alias("_first")
    return (grid.filter(F.col(key).isNotNull())
            .groupBy(key).agg(first)
            .select(F.col("_first." + order).alias(order), F.col(key),
                    *[F.col("_first." + c).alias(c) for c in others]))


def dedupe_grid_window(grid: DataFrame, key: str = "CIV", order: str = "pos") -> DataFrame:
    """W1, window form (row_number per CIV); same result as ``dedupe_grid``."""
    w = Window.partitionBy(key).orderBy(order)
    return (grid.filter(F.col(key).isNotNull())
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))


PRIORITY_ORDER = [("Prioridad", True), ("vulnerables", False), ("muertes", False),
                  ("muertes_vulnerables", False), ("heridos_vulnerables", False)]
TIE_BREAKERS = ["MVINOMBRE", "HORARIO"]


def priority_order_columns():
    cols = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in PRIORITY_ORDER]
    return cols + [F.col(c).asc() for c in TIE_BREAKERS]


def priority_rank(df: DataFrame) -> DataFrame:
    """The priority ordering as an explicit ``rank_pos`` column (1-based, unique).

    Keys of the rank are the report order plus tie-breakers. The window is global, which
    is acceptable only because the scored table is bounded by the corridor grid x 6 blocks;
    for an ordered *file* use ``priority_sort``.
    """
    return df.withColumn("rank_pos", F.row_number().over(Window.orderBy(*priority_order_columns())))


def priority_sort(df: DataFrame) -> DataFrame:
    """Global sort (range-partitioned by Spark, no single-task window)."""
    return df.orderBy(*priority_order_columns())


def top_by(df: DataFrame, order: list, n: int | None = None) -> DataFrame:
    """Ordered rows, optionally the first ``n`` (a top-k report / preview)."""
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def preview(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """Deterministic ``head(n)``: first n rows by a key."""
    return df.orderBy(*key).limit(n)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by name."""
    return a.unionByName(b)
