"""M1: the corridor x time-block feature table over a rolling window.

Single-pass plan (one scan per table):

    injured, killed  --groupBy(FORMULARIO)-->  per-accident counts  (partial agg map-side)
    accidents(window, valid CIV) --left join on FORMULARIO--> per-accident measures
        --groupBy(CIV, hour)--> cells (bounded: CIV x 24)
        --join grid on CIV--> --block--> groupBy(MVINOMBRE, HORARIO)
        --drop zero-death corridors--> severity index

Every later step is a sum over a coarser key, so collapsing the reference's five queries,
five group-bys and chained merges into this plan is exact (see tests). The only shuffles
that see raw rows are the FORMULARIO exchanges; both child sides arrive already
aggregated and hash-partitioned by FORMULARIO, so the two joins share one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.functions.features import hour_block, severity_index
from roadrisk.operators import aggregates as A
from roadrisk.operators.joins import drop_zero_death_corridors
from roadrisk.sources.tables import Tables


def build_features_from(accidents: DataFrame, injured: DataFrame, killed: DataFrame,
                        grid: DataFrame, end, years: int = 3) -> DataFrame:
    measures = A.accident_measures(accidents, injured, killed, end, years)
    return features_of_cells(A.cell_totals(measures, ["CIV", A.HORA]), grid)


def features_of_cells(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """The feature table of measures per (CIV, hour)."""
    named = (cells.join(grid.select("CIV", "MVINOMBRE"), "CIV")
             .withColumn("HORARIO", hour_block(F.col(A.HORA)))
             .filter(F.col("HORARIO").isNotNull()))
    blocks = named.groupBy("MVINOMBRE", "HORARIO").agg(*A._sums())
    out = drop_zero_death_corridors(blocks)
    return out.withColumn("vulnerables", severity_index(F.col("muertes_vulnerables"),
                                                        F.col("heridos_vulnerables")))


def build_features(tables: Tables, end, years: int = 3) -> DataFrame:
    """M1 on the stored tables."""
    return build_features_from(tables.siniestros, tables.conheridos, tables.confallecidos,
                               tables.grid, end, years)


def build_features_five_query(tables: Tables, end, years: int = 3) -> DataFrame:
    """M1 in the reference's shape: A1-A5, J4, A6, J7 + A7, A8. Used to cross-check the
    single-pass plan cell by cell."""
    s, h, k = tables.siniestros, tables.conheridos, tables.confallecidos
    a1 = A.accident_counts(s, end, years)
    a2 = A.injured_counts(s, h, end, years)
    a3 = A.fatal_counts(s, k, h, end, years)
    a4 = A.injured_counts(s, h, end, years, vulnerable=True)
    a5 = A.fatal_counts(s, k, h, end, years, vulnerable=True)
    merged = A.join_features(a1, a2, a3, a4, a5, tables.grid)
    a6 = merged.groupBy("MVINOMBRE", A.DIA, A.HORA).agg(*A._sums())
    return A.corridor_block_totals(A.corridor_day_block_totals(a6))
