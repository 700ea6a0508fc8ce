"""Motorcycle reports (R1-R3): which vehicles meet motorcycles, by severity and accident type.

Plan: motorcycles are counted per accident once (partial aggregation), the windowed
accidents are joined to that one-row-per-accident table, and

* R1 (other vehicles in accidents with a motorcycle) joins the non-motorcycle vehicles,
  pre-counted per (accident, class) for the cross-tab;
* R2 (motorcycles in accidents with more than one) needs no second pass over the vehicles:
  the motorcycle count per accident *is* its contribution.

No step collects a group or pairs vehicles within an accident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.operators import aggregates as A
from roadrisk.operators.filters import rolling_window
from roadrisk.operators.windows import union_all
from roadrisk.schemas import MOTORCYCLE
from roadrisk.session import materialise

ROWS = ["GRAVEDAD", "CLASE_ACC"]


def _window_accidents(accidents: DataFrame, end, years: int) -> DataFrame:
    return rolling_window(accidents, end, years).select("FORMULARIO", "CLASE_ACC", "GRAVEDAD")


def motorcycle_accidents(accidents: DataFrame, vehicles: DataFrame, end, years: int = 3) -> DataFrame:
    """Windowed accidents with their motorcycle count (A9 keys, A10 = n_moto > 1)."""
    moto = A.motorcycles_per_accident(vehicles, MOTORCYCLE)
    return _window_accidents(accidents, end, years).join(moto, "FORMULARIO")


def distinct_motorcycle_accidents(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """SELECT DISTINCT FORMULARIO of windowed accidents with a motorcycle."""
    return motorcycle_accidents(accidents, vehicles, end, years).select("FORMULARIO")


def multi_motorcycle_accidents(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """A10: windowed accidents with more than one motorcycle (GROUP BY .. HAVING)."""
    return (motorcycle_accidents(accidents, vehicles, end, years)
            .filter(F.col("n_moto") > 1).select("FORMULARIO", "n_moto"))


def all_vehicles_of_motorcycle_accidents(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """Every vehicle of a windowed accident that had a motorcycle."""
    acc = motorcycle_accidents(accidents, vehicles, end, years).drop("n_moto")
    return acc.join(vehicles.select("FORMULARIO", F.col("CLASE").alias("CLASE_VEH")), "FORMULARIO")


def other_vehicles(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """Non-motorcycle vehicles in accidents with at least one motorcycle (row form)."""
    acc = motorcycle_accidents(accidents, vehicles, end, years).drop("n_moto")
    others = vehicles.filter(F.col("CLASE") != MOTORCYCLE).select(
        "FORMULARIO", F.col("CLASE").alias("CLASE_VEH"))
    return acc.join(others, "FORMULARIO")


def motorcycle_vs_motorcycle(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """R2: the motorcycles of accidents with more than one motorcycle (row form)."""
    acc = motorcycle_accidents(accidents, vehicles, end, years).filter(F.col("n_moto") > 1).drop("n_moto")
    motos = vehicles.filter(F.col("CLASE") == MOTORCYCLE).select(
        "FORMULARIO", F.col("CLASE").alias("CLASE_VEH"))
    return acc.join(motos, "FORMULARIO")


def motorcycle_vehicle_rows(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """R1 UNION ALL R2 (bag semantics), the input of the cross-tabs."""
    return union_all(other_vehicles(accidents, vehicles, end, years),
                     motorcycle_vs_motorcycle(accidents, vehicles, end, years))


def motorcycle_counts(accidents, vehicles, end, years: int = 3) -> DataFrame:
    """Counts per (GRAVEDAD, CLASE_ACC, CLASE_VEH) of R1 + R2 in one pass over the vehicles.

    Vehicles are counted per (accident, class) -- combined map-side, so a hot accident
    costs one row per class and task. The motorcycle count of each accident is a window
    over those rows (at most one per vehicle class). An accident's row then contributes:
    every non-motorcycle class when it has a motorcycle (R1), and its motorcycles when it
    has more than one (R2). Only these contributions meet the windowed accidents.
    """
    per_class = (vehicles.filter(F.col("CLASE").isNotNull())
                 .groupBy("FORMULARIO", "CLASE").agg(F.count(F.lit(1)).alias("n")))
    n_moto = F.sum(F.when(F.col("CLASE") == MOTORCYCLE, F.col("n")).otherwise(0)).over(
        Window.partitionBy("FORMULARIO"))
    contrib = (per_class.withColumn("n_moto", n_moto)
               .filter(((F.col("CLASE") != MOTORCYCLE) & (F.col("n_moto") >= 1))
                       | ((F.col("CLASE") == MOTORCYCLE) & (F.col("n") > 1))))
    acc = _window_accidents(accidents, end, years).filter(
        F.col("GRAVEDAD").isNotNull() & F.col("CLASE_ACC").isNotNull())
    return (acc.join(contrib, "FORMULARIO")
            .groupBy(*ROWS, F.col("CLASE").alias("CLASE_VEH"))
            .agg(F.sum("n").cast("long").alias("n")))


def motorcycle_crosstab(accidents, vehicles, end, years: int = 3, mode: str = "both") -> DataFrame:
    """Long-form cross-tab with zero cells; ``pct_all`` (A11) and/or ``pct_row``.

    The counts table is bounded by severities x accident types x vehicle classes; it is
    materialised once so the pivot's value discovery, the grand total and the row totals
    read it instead of re-running the joins over the vehicle table.
    """
    counts = materialise(motorcycle_counts(accidents, vehicles, end, years))
    long = A.crosstab_long(counts, ROWS, "CLASE_VEH")
    if mode == "all":
        return A.normalise_all(long)
    if mode == "index":
        return A.normalise_rows(long, ROWS)
    a = A.normalise_all(long).withColumnRenamed("pct", "pct_all")
    return A.normalise_rows(a, ROWS).withColumnRenamed("pct", "pct_row")
