"""M8: features -> min-max scaling -> nearest prototype -> priority label -> report order.

The feature table is bounded by the corridor grid x 6 time blocks, whatever the size of
the incident tables; it is checkpointed once (reliable checkpoint in the shared folder)
before the iterative fit so each iteration scans the small table, not the incident data.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.functions.features import label_to_priority
from roadrisk.functions.scaling import minmax_scale
from roadrisk.operators import kproto
from roadrisk.operators.windows import priority_rank
from roadrisk.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, NUMERIC_FEATURES
from roadrisk.session import materialise  # noqa: F401 (re-exported)

# ---------------------------------------------------------------------------------------
# FIXED VALUES: example prototypes for queries that need a model without fitting one (min-max
# scaled accidentes, muertes, heridos | HORARIO, vulnerables) and gamma. No fit saved them: a
# fitted model comes from fit_model, save_model and load_model.
# ---------------------------------------------------------------------------------------
DEFAULT_MODEL = kproto.KPrototypesModel(
    num_cols=list(NUMERIC_FEATURES),
    cat_cols=list(CATEGORICAL_FEATURES),
    centroids_num=[[0.02, 0.0, 0.02], [0.15, 0.1, 0.15], [0.5, 0.4, 0.5]],
    centroids_cat=[["DiurnoTarde 12-18", 0], ["DiurnoMan 8-12", 1], ["Nocturno 22-2", 2]],
    gamma=0.1,
)

SCALED = {c: f"{c}_scaled" for c in NUMERIC_FEATURES}


def scaled_features(features: DataFrame, scaler: DataFrame | None = None) -> DataFrame:
    """F11 on copies of the numeric columns (``<col>_scaled``), originals kept for the report.
    ``scaler=None`` re-fits on the data being scored (the reference's behaviour)."""
    copies = features.withColumns({s: F.col(c) for c, s in SCALED.items()})
    params = None
    if scaler is not None:
        params = scaler.withColumn("feature", F.concat(F.col("feature"), F.lit("_scaled")))
    return minmax_scale(copies, list(SCALED.values()), params)


def on_scaled(model: kproto.KPrototypesModel) -> kproto.KPrototypesModel:
    return dataclasses.replace(model, num_cols=[SCALED.get(c, c) for c in model.num_cols])


def score(features: DataFrame, model: kproto.KPrototypesModel = DEFAULT_MODEL,
          scaler: DataFrame | None = None, mapping: dict | None = None) -> DataFrame:
    """Scale, assign (M4) and map labels to priorities."""
    sc = scaled_features(features, scaler)
    lab = kproto.assign(sc, on_scaled(model), "label")
    return lab.select(*FEATURE_COLUMNS, "label",
                      label_to_priority(F.col("label"), mapping).alias("Prioridad"))


def predict_priorities(features: DataFrame, model: kproto.KPrototypesModel = DEFAULT_MODEL,
                       scaler: DataFrame | None = None, mapping: dict | None = None,
                       ranked: bool = True) -> DataFrame:
    """M8 (+ W2 when ``ranked``): the scored table with its report position."""
    out = score(features, model, scaler, mapping)
    return priority_rank(out) if ranked else out


def fit_model(features: DataFrame, k: int = 3, n_restarts: int = 50, max_iter: int = 100,
              seed: int = 0, gamma: float | None = None):
    """M6 on the feature table: scale, checkpoint once, fit all restarts together."""
    # Spread the (bounded) table over the cores: every iteration evaluates restarts x k
    # distances per row, and a single input file would put all of it in one task.
    par = features.sparkSession.sparkContext.defaultParallelism
    sc = materialise(scaled_features(features).select(
        "MVINOMBRE", *CATEGORICAL_FEATURES, *SCALED.values()).repartition(par))
    best, summary = kproto.fit(sc, list(SCALED.values()), list(CATEGORICAL_FEATURES), k=k,
                               n_restarts=n_restarts, max_iter=max_iter, gamma=gamma, seed=seed,
                               order_keys=["MVINOMBRE", "HORARIO"])
    best = dataclasses.replace(best, num_cols=list(NUMERIC_FEATURES))
    return best, summary


def fitted_priority_map(scored: DataFrame, k: int = 3) -> dict:
    """Label -> priority text from the cluster ranking (M7): the cluster with the highest
    mean deaths is '1 Priorizado', then '2 Complementario', the rest '3 NA'."""
    names = {1: "1 Priorizado", 2: "2 Complementario"}
    ranks = kproto.rank_clusters(scored).select("label", "priority_rank").collect()  # k rows
    return {r.label: names.get(r.priority_rank, "3 NA") for r in ranks}
