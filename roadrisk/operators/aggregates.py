"""Aggregations A1-A12, A14-A16.

Naming of the measure columns follows the feature table: accidentes, muertes, heridos,
muertes_vulnerables, heridos_vulnerables. Every sum is cast to BIGINT.

Null grouping keys are removed before each ``groupBy`` (pandas drops them, Spark keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.functions.features import hour_block, severity_index
from roadrisk.operators.filters import rolling_window, severity_filter, valid_corridor
from roadrisk.operators.joins import (drop_zero_death_corridors, fatal_with_injured,
                                      person_counts)
from roadrisk.schemas import SEVERITY_INJURED

DIA, HORA = "DIA_OCURRENCIA_ACC", "HORA_OCURRENCIA_ACC"
CELL = ["CIV", DIA, HORA]
MEASURES = ["accidentes", "muertes", "heridos", "muertes_vulnerables", "heridos_vulnerables"]


def _sum(col: str, alias: str | None = None) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast("long").alias(alias or col)


def _sums(cols=MEASURES) -> list[Column]:
    return [_sum(c) for c in cols]


def _not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def windowed_accidents(accidents: DataFrame, end, years: int = 3) -> DataFrame:
    """P1 + P2 + non-null cell keys: the accident rows every feature query starts from."""
    return _not_null(valid_corridor(rolling_window(accidents, end, years)), [DIA, HORA])


# --- the five reference-shaped counts (each per (CIV, day, hour)) ----------------------

def accident_counts(accidents: DataFrame, end, years: int = 3) -> DataFrame:
    """A1: accidents per (CIV, day, hour)."""
    return (windowed_accidents(accidents, end, years)
            .groupBy(*CELL).agg(F.count(F.lit(1)).alias("accidentes")))


def injured_counts(accidents: DataFrame, injured: DataFrame, end, years: int = 3,
                   vulnerable: bool = False) -> DataFrame:
    """A2 (A4 with ``vulnerable``): injured of CON HERIDOS accidents per (CIV, day, hour).
    Injured are counted per accident first (J1 + count), then summed per cell."""
    acc = severity_filter(windowed_accidents(accidents, end, years), SEVERITY_INJURED)
    ic = person_counts(injured, "h")
    col, name = ("h_v", "heridos_vulnerables") if vulnerable else ("h_n", "heridos")
    return acc.join(ic, "FORMULARIO").groupBy(*CELL).agg(_sum(col, name))


def fatal_counts(accidents: DataFrame, killed: DataFrame, injured: DataFrame, end,
                 years: int = 3, vulnerable: bool = False) -> DataFrame:
    """A3 (A5 with ``vulnerable``): killed and injured of accidents with killed persons,
    per (CIV, day, hour) (J3 then sums)."""
    j = fatal_with_injured(windowed_accidents(accidents, end, years), killed, injured)
    if vulnerable:
        return j.groupBy(*CELL).agg(_sum("m_v", "muertes_vulnerables"),
                                    _sum("h_v", "heridos_vulnerables"))
    return j.groupBy(*CELL).agg(_sum("m_n", "muertes"), _sum("h_n", "heridos"))


def join_features(a1: DataFrame, a2: DataFrame, a3: DataFrame, a4: DataFrame, a5: DataFrame,
                  grid: DataFrame) -> DataFrame:
    """The five counts left-joined on the cell, named corridors attached, missing -> 0,
    and the two injured halves added (which keeps the double count of T12)."""
    a3 = a3.withColumnRenamed("heridos", "heridos_f")
    a5 = a5.withColumnRenamed("heridos_vulnerables", "heridos_vulnerables_f")
    j = (a1.join(a2, CELL, "left").join(a3, CELL, "left").join(a4, CELL, "left")
         .join(a5, CELL, "left").join(grid.select("CIV", "MVINOMBRE"), "CIV"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select(
        "MVINOMBRE", *CELL, z("accidentes").alias("accidentes"), z("muertes").alias("muertes"),
        (z("heridos") + z("heridos_f")).alias("heridos"),
        z("muertes_vulnerables").alias("muertes_vulnerables"),
        (z("heridos_vulnerables") + z("heridos_vulnerables_f")).alias("heridos_vulnerables"))


def paired_features(accidents: DataFrame, killed: DataFrame, injured: DataFrame, grid: DataFrame,
                    end, years: int = 3) -> DataFrame:
    """J4 with one aggregate for A2 and A4 and one for A3 and A5: each pair counts the same
    joined rows, so one pass gives both columns."""
    acc = windowed_accidents(accidents, end, years)
    hurt = (severity_filter(acc, SEVERITY_INJURED).join(person_counts(injured, "h"), "FORMULARIO")
            .groupBy(*CELL).agg(_sum("h_n", "heridos"), _sum("h_v", "heridos_vulnerables")))
    dead = (fatal_with_injured(acc, killed, injured).groupBy(*CELL)
            .agg(_sum("m_n", "muertes"), _sum("h_n", "heridos_f"), _sum("m_v", "muertes_vulnerables"),
                 _sum("h_v", "heridos_vulnerables_f")))
    j = (accident_counts(accidents, end, years).join(hurt, CELL, "left").join(dead, CELL, "left")
         .join(grid.select("CIV", "MVINOMBRE"), "CIV"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select(
        "MVINOMBRE", *CELL, z("accidentes").alias("accidentes"), z("muertes").alias("muertes"),
        (z("heridos") + z("heridos_f")).alias("heridos"), z("muertes_vulnerables").alias("muertes_vulnerables"),
        (z("heridos_vulnerables") + z("heridos_vulnerables_f")).alias("heridos_vulnerables"))


# --- single-pass form (one scan per table, see plans.features) -------------------------

def accident_measures(accidents: DataFrame, injured: DataFrame, killed: DataFrame, end,
                      years: int = 3) -> DataFrame:
    """One row per windowed accident with its contribution to every measure.

    heridos weight = [GRAVEDAD = CON HERIDOS] + [accident has killed persons]: the injured
    of a CON HERIDOS accident that also has killed rows are counted twice, exactly as the
    five-query form does (trap T12).
    """
    acc = windowed_accidents(accidents, end, years).select("FORMULARIO", *CELL, "GRAVEDAD")
    return measures_of(acc, injured, killed, CELL)


def measures_of(acc: DataFrame, injured: DataFrame, killed: DataFrame, keep: list[str]) -> DataFrame:
    """The measures of the given accidents (FORMULARIO, GRAVEDAD and the columns to ``keep``)."""
    ic = person_counts(injured, "h")
    kc = person_counts(killed, "m")
    j = acc.join(ic, "FORMULARIO", "left").join(kc, "FORMULARIO", "left")
    w = (F.when(F.col("GRAVEDAD") == SEVERITY_INJURED, 1).otherwise(0)
         + F.when(F.col("m_n").isNotNull(), 1).otherwise(0))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select("FORMULARIO", *keep,
                    z("m_n").alias("muertes"), (z("h_n") * w).alias("heridos"),
                    z("m_v").alias("muertes_vulnerables"),
                    (z("h_v") * w).alias("heridos_vulnerables"))


def cell_totals(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Accident count and measure sums per ``keys`` (partial aggregation map-side)."""
    return measures.groupBy(*keys).agg(F.count(F.lit(1)).alias("accidentes"), *_sums(MEASURES[1:]))


def corridor_hour_totals(accidents: DataFrame, injured: DataFrame, killed: DataFrame,
                         grid: DataFrame, end, years: int = 3) -> DataFrame:
    """Five sums per (MVINOMBRE, day, hour). Cells are reduced per CIV before the grid
    join, so the join input is bounded by CIV x 7 x 24 rows."""
    cells = cell_totals(accident_measures(accidents, injured, killed, end, years), CELL)
    named = cells.join(grid.select("CIV", "MVINOMBRE"), "CIV")
    return named.groupBy("MVINOMBRE", DIA, HORA).agg(*_sums())


def corridor_day_block_totals(hour_totals: DataFrame) -> DataFrame:
    """J7 + F9 + A7: zero-death corridors dropped, sums per (MVINOMBRE, day, block)."""
    df = drop_zero_death_corridors(hour_totals).withColumn("HORARIO", hour_block(F.col(HORA)))
    return _not_null(df, ["HORARIO"]).groupBy("MVINOMBRE", DIA, "HORARIO").agg(*_sums())


def corridor_block_totals(day_block_totals: DataFrame) -> DataFrame:
    """A8 + F10: sums per (MVINOMBRE, block) and the severity index."""
    df = day_block_totals.groupBy("MVINOMBRE", "HORARIO").agg(*_sums())
    return df.withColumn("vulnerables", severity_index(F.col("muertes_vulnerables"),
                                                       F.col("heridos_vulnerables")))


# --- motorcycle reports ------------------------------------------------------------------

def motorcycles_per_accident(vehicles: DataFrame, motorcycle: str) -> DataFrame:
    """Motorcycles per accident (partial aggregation, one row per accident with motorcycles).
    Its key set is A9; ``n_moto > 1`` is A10."""
    return (vehicles.filter(F.col("CLASE") == motorcycle)
            .groupBy("FORMULARIO").agg(F.count(F.lit(1)).alias("n_moto")))


def crosstab_long(counts: DataFrame, rows: list[str], col: str, value: str = "n") -> DataFrame:
    """Cross-tab in long form with the zero cells pandas would show.

    Every observed row of the table carries the list of observed column keys (a scalar
    subquery over the already aggregated counts) and the counts it has; cells it lacks are
    0. No pivot, so no driver job and no limit on the number of column keys.
    """
    keys = counts.agg(F.array_sort(F.collect_set(col)).alias("k")).select("k").scalar()
    have = (counts.groupBy(*rows, col).agg(F.sum(value).cast("long").alias("_n"))
            .groupBy(*rows).agg(F.map_from_entries(F.collect_list(F.struct(col, "_n"))).alias("_have")))
    return (have.select(*rows, "_have", F.explode(keys).alias(col))
            .select(*rows, col, F.coalesce(F.element_at("_have", F.col(col)), F.lit(0)).cast("long").alias(value)))


def normalise_all(long: DataFrame, value: str = "n") -> DataFrame:
    """Each cell as % of the grand total (scalar subquery for the total)."""
    total = long.agg(F.sum(value)).scalar()
    return long.withColumn("pct", F.col(value).cast("double") * 100.0 / total)


def normalise_rows(long: DataFrame, rows: list[str], value: str = "n") -> DataFrame:
    """Each cell as % of its row total (window over the bounded crosstab rows)."""
    total = F.sum(value).over(Window.partitionBy(*rows))
    return long.withColumn("pct", F.col(value).cast("double") * 100.0 / total)


# --- profiles and reconciliations --------------------------------------------------------

def null_profile(df: DataFrame) -> DataFrame:
    """Per column, row count and non-null count (and the Spark type), one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("ordinal"),
                                 F.lit(t).alias("spark_type"), F.col(f"_nn{i}").alias("non_null"))
                        for i, (c, t) in enumerate(df.dtypes)])
    return (one.select(F.col("_rows").alias("rows"), F.explode(entries).alias("_e"))
            .select("_e.column_name", "_e.ordinal", "_e.spark_type", "rows", "_e.non_null",
                    (F.col("rows") - F.col("_e.non_null")).alias("nulls")))


def death_states(actors: DataFrame) -> DataFrame:
    """A15 detail: actors per (ESTADO, MUERTE_POSTERIOR), nulls kept as their own group."""
    return actors.groupBy("ESTADO", "MUERTE_POSTERIOR").agg(F.count(F.lit(1)).alias("n"))


def reconcile_deaths(actors: DataFrame, killed: DataFrame) -> DataFrame:
    """Actors whose final state is MUERTO vs rows of the killed table."""
    k = killed.agg(F.count(F.lit(1))).scalar()
    return (actors.agg(F.count_if(F.col("ESTADO") == "MUERTO").alias("estado_muerto"),
                       F.count_if((F.col("ESTADO") == "HERIDO") & (F.col("MUERTE_POSTERIOR") == "S"))
                       .alias("herido_posterior"),
                       F.count_if((F.col("ESTADO") == "ILESO") & (F.col("MUERTE_POSTERIOR") == "S"))
                       .alias("ileso_posterior"),
                       F.count_if(F.col("ESTADO_FINAL") == "MUERTO").alias("final_muerto"))
            .withColumn("killed_rows", k)
            .withColumn("difference", F.col("final_muerto") - F.col("killed_rows")))


def cluster_profile(scored: DataFrame, by: list[str], label: str = "label",
                    cols=("accidentes", "muertes", "heridos")) -> DataFrame:
    """Per label x ``by``: n, min, median, max of each feature (exact median)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.median(c).alias(f"{c}_median"),
                 F.max(c).cast("double").alias(f"{c}_max")]
    return scored.groupBy(label, *by).agg(*aggs)
