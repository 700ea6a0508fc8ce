"""Mixed-type clustering (k-prototypes, Huang 1998) with Cao initialisation (Cao, Liang &
Bai 2009), written as Spark jobs.

* distance(x, c) = sum_i (x_i - c_i)^2 over the numeric columns
                   + gamma * #(categorical attributes where x_a != c_a)
* assignment (M4): k distance columns from literal centroids, arg-min (lowest label wins)
* update (M5): mean of numerics, mode of categoricals (smallest value wins ties), per label
* fit (M6): every restart advances in the *same* Spark job each iteration: rows carry one
  (restart, label, distance) entry per active restart (a fixed replication factor, the
  restart count), and one ``groupBy(restart, label)`` produces all the new centroids.
  Only k x restarts centroid rows ever reach the driver.

Deviations from the single-machine library (documented): centroids are updated in batch
(Lloyd style) rather than point by point; an empty cluster keeps its previous centroid;
the numeric part of the initial centroids is mean + N(0,1) * std drawn from a seeded
generator per restart, so fits are reproducible; the cheapest fit is kept as is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class KPrototypesModel:
    num_cols: list[str]
    cat_cols: list[str]
    centroids_num: list[list[float]]
    centroids_cat: list[list]
    gamma: float
    cost: float | None = None
    n_iter: int = 0
    restart: int = 0
    sizes: list[int] = field(default_factory=list)

    @property
    def k(self) -> int:
        return len(self.centroids_num)

    # --- S10: persistence as a small table ------------------------------------------------
    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(j, [float(v) for v in self.centroids_num[j]],
                 [None if v is None else str(v) for v in self.centroids_cat[j]],
                 float(self.gamma), json.dumps({"num": self.num_cols, "cat": self.cat_cols}))
                for j in range(self.k)]
        return spark.createDataFrame(rows, "cluster int, num array<double>, cat array<string>, "
                                           "gamma double, columns string")

    @classmethod
    def from_frame(cls, df: DataFrame, cat_types: dict | None = None) -> KPrototypesModel:
        rows = sorted(df.collect(), key=lambda r: r.cluster)  # k rows
        cols = json.loads(rows[0].columns)
        conv = cat_types or {}
        cats = [[(conv.get(c, str)(v) if v is not None else None) for c, v in zip(cols["cat"], r.cat)]
                for r in rows]
        return cls(cols["num"], cols["cat"], [list(r.num) for r in rows], cats, rows[0].gamma)


# --- distances and assignment (M4) ----------------------------------------------------------

def distance(model: KPrototypesModel, j: int) -> Column:
    d = None
    for c, m in zip(model.num_cols, model.centroids_num[j]):
        diff = F.col(c) - F.lit(float(m))
        d = diff * diff if d is None else d + diff * diff
    mis = None
    for c, v in zip(model.cat_cols, model.centroids_cat[j]):
        t = F.when(F.col(c) == F.lit(v), F.lit(0)).otherwise(F.lit(1))
        mis = t if mis is None else mis + t
    if mis is None:
        return d
    return d + F.lit(float(model.gamma)) * mis if d is not None else F.lit(float(model.gamma)) * mis


def assignment(model: KPrototypesModel) -> tuple[Column, Column]:
    """(label, distance to the assigned centroid) as column expressions."""
    ds = [distance(model, j) for j in range(model.k)]
    if model.k == 1:
        return F.lit(0), ds[0]
    best = F.least(*ds)
    label = None
    for j, d in enumerate(ds[:-1]):
        label = F.when(d == best, F.lit(j)) if label is None else label.when(d == best, F.lit(j))
    return label.otherwise(F.lit(model.k - 1)), best


def assign(df: DataFrame, model: KPrototypesModel, label: str = "label",
           dist: str | None = None) -> DataFrame:
    """M4: label each row with its nearest prototype (lowest label wins ties)."""
    lab, d = assignment(model)
    out = df.withColumn(label, lab)
    return out.withColumn(dist, d) if dist else out


def cost(df: DataFrame, model: KPrototypesModel) -> DataFrame:
    """M7: total cost (sum of distances to the assigned prototypes), one row."""
    _, d = assignment(model)
    return df.agg(F.sum(d).alias("cost"), F.count(F.lit(1)).alias("n"))


def rank_clusters(scored: DataFrame, label: str = "label", by: str = "muertes") -> DataFrame:
    """M7: clusters ordered by the mean of ``by`` (descending; rank 1 = highest priority).
    The grouped table has k rows, so its global rank window is bounded by k."""
    from pyspark.sql import Window
    g = scored.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg(by).alias(f"mean_{by}"),
                                  F.avg("accidentes").alias("mean_accidentes"))
    w = Window.orderBy(F.col(f"mean_{by}").desc(), F.col(label))
    return g.withColumn("priority_rank", F.row_number().over(w))


# --- update (M5) ------------------------------------------------------------------------------

def update(labelled: DataFrame, num_cols: list[str], cat_cols: list[str],
           label: str = "label", keys: list[str] | None = None, dist: str | None = None) -> DataFrame:
    """M5: per label (and ``keys``, e.g. restart): size, numeric means, categorical modes
    (lowest value on ties), and the summed distance when ``dist`` is given.

    One ``groupBy``: ``mode`` keeps a value -> count map per group whose size is bounded by
    the attribute's domain, and it combines map-side like the sums.
    """
    keys = (keys or []) + [label]
    aggs = [F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(c) for c in num_cols],
            *[F.mode(c, True).alias(c) for c in cat_cols]]
    if dist:
        aggs.append(F.sum(dist).alias("cost"))
    return labelled.groupBy(*keys).agg(*aggs)


# --- Cao initialisation (M2, M3) ---------------------------------------------------------------

def cao_density(df: DataFrame, cat_cols: list[str], out: str = "density") -> DataFrame:
    """M2: mean over categorical attributes of the relative frequency of the row's value.

    Frequencies are a ``groupBy(attribute)`` (one row per distinct value of a categorical
    attribute, whose domain is fixed and small) joined back; n is a scalar subquery.
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    out_df, terms = df, []
    for i, c in enumerate(cat_cols):
        freq = df.groupBy(c).agg(F.count(F.lit(1)).alias(f"_f{i}"))
        out_df = out_df.join(freq, c, "left")  # AQE decides by size
        terms.append(F.col(f"_f{i}") / n)
    dens = terms[0]
    for t in terms[1:]:
        dens = dens + t
    return out_df.withColumn(out, dens / float(len(cat_cols))).drop(*[f"_f{i}" for i in range(len(cat_cols))])


def _mismatch(cat_cols: list[str], values: list) -> Column:
    m = None
    for c, v in zip(cat_cols, values):
        t = F.when(F.col(c) == F.lit(v), F.lit(0)).otherwise(F.lit(1))
        m = t if m is None else m + t
    return m


def cao_init(df: DataFrame, cat_cols: list[str], k: int, order_keys: list[str]) -> list[list]:
    """M3: categorical initial centroids.

    c1 = the densest row; c_j = arg-max over rows of min over chosen c of
    (mismatches(x, c) * density(x)). Ties go to the smallest ``order_keys``. Each round is
    one ``min_by`` aggregate; only the chosen row's values reach the driver.
    """
    from roadrisk.session import materialise
    dens = materialise(cao_density(df, cat_cols))  # k rounds read it; bounded like ``df``
    order = [F.col(c) for c in order_keys]
    chosen: list[list] = []
    for j in range(k):
        if not chosen:
            score = F.col("density")
        else:
            score = F.least(*[_mismatch(cat_cols, c) * F.col("density") for c in chosen]) \
                if len(chosen) > 1 else _mismatch(cat_cols, chosen[0]) * F.col("density")
        pick = dens.agg(F.min_by(F.struct(*[F.col(c) for c in cat_cols]),
                                 F.struct(-score, *order)).alias("c")).collect()[0].c
        chosen.append([pick[c] for c in cat_cols])
    return chosen


# --- fit (M6) --------------------------------------------------------------------------------

def _prototypes_literal(models: list[KPrototypesModel], cat_types: list[str]) -> Column:
    """All prototypes of several models as one literal array<struct<restart, num, cat..>>.

    Shipped as one JSON string and parsed by ``from_json``; constant folding evaluates it
    once into a single literal object, so the generated code does not change from one
    iteration to the next and building it costs one call, not one per value.
    """
    rows = [{"restart": m.restart, "num": [[float(v) for v in c] for c in m.centroids_num],
             **{f"cat{a}": [c[a] for c in m.centroids_cat] for a in range(len(m.cat_cols))}}
            for m in models]
    fields = ["restart:int", "num:array<array<double>>"] + [
        f"cat{a}:array<{t}>" for a, t in enumerate(cat_types)]
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{','.join(fields)}>>")


def _assign_all(models: list[KPrototypesModel], num_cols: list[str], cat_cols: list[str],
                k: int, gamma: float, cat_types: list[str]) -> Column:
    """Per row: array of (restart, label, dist), one entry per model, via higher-order
    functions over the literal prototypes (label = first index of the minimum)."""
    def dists(r):
        def one(j):
            d = None
            for i, c in enumerate(num_cols):
                diff = F.col(c) - r["num"][j][i]
                d = diff * diff if d is None else d + diff * diff
            mis = None
            for a, c in enumerate(cat_cols):
                t = F.when(F.col(c) == r[f"cat{a}"][j], F.lit(0)).otherwise(F.lit(1))
                mis = t if mis is None else mis + t
            return d if mis is None else d + F.lit(float(gamma)) * mis
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), one)

    def entry(r):
        ds = dists(r)
        best = F.array_min(ds)
        return F.struct(r["restart"].alias("restart"),
                        (F.array_position(ds, best) - 1).cast("int").alias("label"),
                        best.alias("dist"))

    return F.transform(_prototypes_literal(models, cat_types), entry)


def default_gamma(df: DataFrame, num_cols: list[str]) -> float:
    """0.5 x mean population standard deviation of the numeric columns."""
    r = df.agg(*[F.stddev_pop(c).alias(c) for c in num_cols]).collect()[0]
    return 0.5 * float(np.mean([r[c] or 0.0 for c in num_cols]))


def _same(a: KPrototypesModel, b: KPrototypesModel, tol: float = 1e-12) -> bool:
    return (np.allclose(np.array(a.centroids_num), np.array(b.centroids_num), rtol=0, atol=tol)
            and a.centroids_cat == b.centroids_cat)


def fit(df: DataFrame, num_cols: list[str], cat_cols: list[str], k: int = 3,
        n_restarts: int = 50, max_iter: int = 100, gamma: float | None = None, seed: int = 0,
        order_keys: list[str] | None = None) -> tuple[KPrototypesModel, list[dict]]:
    """M6: k-prototypes with ``n_restarts`` restarts advanced together; the cheapest kept.

    ``df`` should be materialised (checkpointed) by the caller: it is scanned once per
    iteration. Returns the cheapest of the restarts that converged and one summary dict per
    restart (``converged`` among its keys); none converged is an error.
    """
    order_keys = order_keys or cat_cols
    gamma = default_gamma(df, num_cols) if gamma is None else float(gamma)
    cats = cao_init(df, cat_cols, k, order_keys)
    mom = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(num_cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(num_cols)]).collect()[0]
    mean = np.array([mom[f"m{i}"] for i in range(len(num_cols))], dtype=float)
    std = np.array([mom[f"s{i}"] or 0.0 for i in range(len(num_cols))], dtype=float)
    cat_sql_types = [df.schema[c].dataType.simpleString() for c in cat_cols]

    models = {}
    for r in range(n_restarts):
        z = np.random.default_rng(seed + r).standard_normal((k, len(num_cols)))
        models[r] = KPrototypesModel(num_cols, cat_cols, (mean + z * std).tolist(),
                                     [list(c) for c in cats], gamma, restart=r)
    active = set(models)
    history = {r: [] for r in models}
    it = 0
    while active and it < max_iter:
        it += 1
        act = sorted(active)
        dist = df.select(*num_cols, *cat_cols,
                         _assign_all([models[r] for r in act], num_cols, cat_cols, k, gamma,
                                     cat_sql_types).alias("_a"))
        labelled = dist.select(*num_cols, *cat_cols, F.explode("_a").alias("e")) \
            .select(*num_cols, *cat_cols, "e.restart", "e.label", "e.dist")
        upd = update(labelled, num_cols, cat_cols, keys=["restart"], dist="dist").collect()
        costs: dict[int, float] = {}
        for row in upd:
            costs[row.restart] = costs.get(row.restart, 0.0) + row.cost
        by_r: dict[int, dict[int, object]] = {}
        for row in upd:
            by_r.setdefault(row.restart, {})[row.label] = row
        for r in sorted(active):
            old = models[r]
            new_num = [list(v) for v in old.centroids_num]
            new_cat = [list(v) for v in old.centroids_cat]
            sizes = [0] * k
            for j, row in by_r.get(r, {}).items():
                new_num[j] = [float(row[c]) for c in num_cols]
                new_cat[j] = [row[c] for c in cat_cols]
                sizes[j] = row.size
            new = KPrototypesModel(num_cols, cat_cols, new_num, new_cat, gamma, restart=r,
                                   n_iter=it, sizes=sizes)
            history[r].append(costs.get(r))
            if _same(old, new):
                new.cost = costs.get(r)
                active.discard(r)
            models[r] = new
    for r in active:  # did not converge within max_iter: cost of the last assignment
        models[r].cost = history[r][-1]
    settled = [m for r, m in models.items() if r not in active]
    if not settled:
        raise RuntimeError(f"none of {n_restarts} restarts converged in {max_iter} iterations")
    best = min(settled, key=lambda m: (m.cost, m.restart))  # an unconverged fit never wins
    summary = [{"restart": r, "cost": models[r].cost, "iterations": models[r].n_iter, "converged": r not in active,
                "cost_history": history[r]} for r in sorted(models)]
    return best, summary
