"""M8 x F13: scoring for a table of requested dates as one job.

A request asks for the priorities as of a day. Instead of one window a request, every
accident is counted once, in the cell of its corridor, time block and day; a corridor and
block's cells become running totals over the days, and the features of any window are the
difference of the totals at its two bounds:

    measures (one scan a table) -> day cells -> running totals, read at the bounds of all
    dates -> features by date -> scale, assign and label within each date -> requests

Running totals and bounds meet in one window per corridor and block, whose rows are days and
dates (bounded by the calendar, not by the accidents). Equal dates are computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadrisk.functions.calendar import clamp_as_of
from roadrisk.functions.features import hour_block, label_to_priority, severity_index
from roadrisk.operators import aggregates as A
from roadrisk.operators import kproto
from roadrisk.operators.filters import valid_corridor
from roadrisk.plans.prediction import DEFAULT_MODEL, SCALED, on_scaled
from roadrisk.schemas import FEATURE_COLUMNS, NUMERIC_FEATURES

KEY = ["MVINOMBRE", "HORARIO"]


def day_cells(tables) -> DataFrame:
    """The five measures per (MVINOMBRE, HORARIO, FECHA_ACC)."""
    day = "FECHA_ACC"
    acc = A._not_null(valid_corridor(tables.siniestros), [A.DIA, A.HORA, day]).select("FORMULARIO", *A.CELL, "GRAVEDAD", day)
    measures = A.measures_of(acc, tables.conheridos, tables.confallecidos, [*A.CELL, day])
    cells = A.cell_totals(measures, ["CIV", A.HORA, day])
    named = cells.join(tables.grid.select("CIV", "MVINOMBRE"), "CIV").withColumn("HORARIO", hour_block(F.col(A.HORA)))
    return named.where("HORARIO IS NOT NULL").groupBy(*KEY, day).agg(*A._sums())


def features_as_of(cells: DataFrame, dates: DataFrame, years: int = 3) -> DataFrame:
    """The feature table of every distinct ``as_of`` of ``dates`` (nulls are ignored), by date."""
    # both bounds of every date: rows up to the date count, rows up to the window's start don't
    d = F.col("as_of")
    both = F.array(F.struct(d.alias("as_of"), d.alias("day"), F.lit(1).alias("sign")),
                   F.struct(d.alias("as_of"), F.add_months(d, -12 * years).alias("day"), F.lit(-1).alias("sign")))
    bounds = (dates.where("as_of IS NOT NULL").select("as_of").distinct().select(F.explode(both).alias("b"))
              .agg(F.collect_list("b").alias("b"))).scalar()  # two a day of the calendar at most
    zero = [F.lit(0).cast("long").alias(c) for c in A.MEASURES]
    at = (cells.select(*KEY).distinct().select(*KEY, F.explode(bounds).alias("b"))
          .select(*KEY, F.col("b.day").alias("day"), "b.as_of", "b.sign", *zero))
    days = cells.select(*KEY, F.col("FECHA_ACC").alias("day"), F.lit(None).cast("date").alias("as_of"),
                        F.lit(0).alias("sign"), *A.MEASURES)
    # a day's own cell comes before the bounds on it: windows hold their last day
    so_far = (Window.partitionBy(*KEY).orderBy("day", F.col("as_of").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = days.unionByName(at).select(*KEY, "as_of", "sign", *[F.sum(c).over(so_far).alias(c) for c in A.MEASURES])
    sums = (totals.where("as_of IS NOT NULL").groupBy("as_of", *KEY)
            .agg(*[F.sum(F.col(c) * F.col("sign")).cast("long").alias(c) for c in A.MEASURES]).where("accidentes > 0"))
    deaths = F.sum("muertes").over(Window.partitionBy("as_of", "MVINOMBRE"))  # at most one row a block
    return (sums.withColumn("_deaths", deaths).where("_deaths > 0").drop("_deaths")
            .withColumn("vulnerables", severity_index(F.col("muertes_vulnerables"), F.col("heridos_vulnerables"))))


def score_as_of(features: DataFrame, model: kproto.KPrototypesModel = DEFAULT_MODEL, mapping: dict | None = None) -> DataFrame:
    """Scale, assign and label the features of each date on their own (as a run for that date does)."""
    ends = features.groupBy("as_of").agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in NUMERIC_FEATURES
                                           for n, f in (("mn", F.min), ("mx", F.max))])
    scaled = features.join(ends, "as_of").withColumns({
        s: F.when(F.col(f"mx_{c}") - F.col(f"mn_{c}") == 0, F.lit(0.0))
        .otherwise((F.col(c).cast("double") - F.col(f"mn_{c}")) / (F.col(f"mx_{c}") - F.col(f"mn_{c}")))
        for c, s in SCALED.items()})
    lab = kproto.assign(scaled, on_scaled(model), "label")
    return lab.select("as_of", *FEATURE_COLUMNS, "label", label_to_priority(F.col("label"), mapping).alias("Prioridad"))


def score_requests(tables, requests: DataFrame, horizon=(2023, 1), min_year: int = 2018, max_year: int = 2023,
                   years: int = 3, model: kproto.KPrototypesModel = DEFAULT_MODEL) -> DataFrame:
    """Every valid request (year, month, day, ...) with the scored rows of its date; requests
    that aren't valid (F13), or whose window has no accident, have no rows."""
    asked = clamp_as_of(requests, horizon, min_year, max_year).where("valid").drop("valid")
    scored = score_as_of(features_as_of(day_cells(tables), asked, years), model)
    return asked.join(scored, "as_of").select(*requests.columns, *scored.columns)
