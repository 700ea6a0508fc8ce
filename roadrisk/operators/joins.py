"""Equi-joins of the incident star schema.

Child layers are always reduced to one row per accident (``person_counts``) *before* they
meet the accident table: the aggregate combines map-side, so an accident that owns a huge
share of the child rows never reaches a join task whole, and the join sees unique keys on
both sides (no fan-out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.operators.filters import is_vulnerable

KEY = "FORMULARIO"


def person_counts(persons: DataFrame, prefix: str) -> DataFrame:
    """Per accident: number of persons and number of vulnerable persons."""
    return persons.groupBy(KEY).agg(
        F.count(F.lit(1)).alias(f"{prefix}_n"),
        F.count_if(is_vulnerable()).alias(f"{prefix}_v"))


def accident_injured(accidents: DataFrame, injured: DataFrame) -> DataFrame:
    """Accident x injured person, inner, 1:n."""
    return accidents.join(injured, KEY)


def accident_killed(accidents: DataFrame, killed: DataFrame) -> DataFrame:
    """Accident x killed person, inner, 1:n."""
    return accidents.join(killed, KEY)


def fatal_with_injured(accidents: DataFrame, killed: DataFrame, injured: DataFrame) -> DataFrame:
    """Accidents with at least one killed person, with their killed and injured counts
    (all and vulnerable). Killed are aggregated first, injured are left-joined as counts."""
    kc = person_counts(killed, "m")
    ic = person_counts(injured, "h")
    return (accidents.join(kc, KEY).join(ic, KEY, "left")
            .withColumns({"h_n": F.coalesce("h_n", F.lit(0)), "h_v": F.coalesce("h_v", F.lit(0))}))


def keep_known(child: DataFrame, accidents: DataFrame) -> DataFrame:
    """Child rows whose accident is known (left semi join; no key lists, no chunking)."""
    return child.join(accidents.select(KEY), KEY, "left_semi")


def drop_zero_death_corridors(df: DataFrame, corridor: str = "MVINOMBRE",
                              deaths: str = "muertes") -> DataFrame:
    """Drop corridors whose deaths sum to zero.

    Applied to per-(corridor, day, hour) or per-(corridor, block) tables, whose rows per
    corridor are bounded (<= 7 x 24), so the corridor window never grows with the data.
    """
    total = F.sum(deaths).over(Window.partitionBy(corridor))
    return df.withColumn("_deaths", total).filter(F.col("_deaths") > 0).drop("_deaths")


def drop_zero_death_corridors_anti(df: DataFrame, corridor: str = "MVINOMBRE",
                                   deaths: str = "muertes") -> DataFrame:
    """J7, anti-join form: same result as ``drop_zero_death_corridors``."""
    zero = df.groupBy(corridor).agg(F.sum(deaths).alias("_d")).filter("_d = 0").select(corridor)
    return df.join(zero, corridor, "left_anti")
