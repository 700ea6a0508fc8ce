"""Feature scaling and encodings: min/max fit (A13), min-max scaling (F11), category codes
(F14), one-hot columns (F15) and the Yeo-Johnson power transform (F16).

Fitted parameters are small tables (one row per feature). Statistics over the data are
attached as scalar subqueries (``DataFrame.scalar()``), which Spark evaluates once and
broadcasts as a value: no cross join, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadrisk.schemas import NUMERIC_FEATURES
from roadrisk.session import materialise


def minmax_params(df: DataFrame, cols=NUMERIC_FEATURES) -> DataFrame:
    """(feature, min_value, max_value) per column, from one aggregate pass."""
    one = df.agg(*[x for c in cols for x in (F.min(c).cast("double").alias(f"_mn{c}"),
                                             F.max(c).cast("double").alias(f"_mx{c}"))])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_mn{c}").alias("min_value"),
                                 F.col(f"_mx{c}").alias("max_value")) for c in cols])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def _scaled(x: Column, mn: Column, mx: Column) -> Column:
    rng = mx - mn
    return F.when(rng == 0, F.lit(0.0)).otherwise((x.cast("double") - mn) / rng)


def minmax_scale(df: DataFrame, cols=NUMERIC_FEATURES, params: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min) per column; a constant column scales to 0.

    ``params=None`` re-fits on ``df`` itself (what the scoring scripts do); otherwise the
    saved (feature, min_value, max_value) table is used.
    """
    if params is None:
        stats = df.agg(F.struct(*[x for c in cols for x in (
            F.min(c).cast("double").alias(f"mn_{c}"), F.max(c).cast("double").alias(f"mx_{c}"))]))
        s = stats.scalar()
        return df.withColumns({c: _scaled(F.col(c), s[f"mn_{c}"], s[f"mx_{c}"]) for c in cols})
    out = df
    for c in cols:
        p = params.filter(F.col("feature") == c).agg(
            F.struct(F.first("min_value").alias("mn"), F.first("max_value").alias("mx"))).scalar()
        out = out.withColumn(c, _scaled(F.col(c), p["mn"], p["mx"]))
    return out


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """string -> dense code in sorted order (0-based); null has no code.

    The distinct values are dealt to tasks by range and sorted there, so a value's code is its
    place in its task plus the number of values in the tasks before. Only one count a task
    comes to the driver, and no window runs over all values.
    """
    out = out or f"{col}_code"
    values = df.select(col).distinct().filter(F.col(col).isNotNull())
    # the id holds the task in its upper bits and the place in the lower 33
    placed = materialise(values.repartitionByRange(col).sortWithinPartitions(col)
                         .withColumn("_at", F.monotonically_increasing_id()), "category-codes")
    task = F.shiftright("_at", 33).cast("int")
    before, offsets = 0, []
    for r in placed.groupBy(task.alias("_task")).count().orderBy("_task").collect():
        offsets.append((r["_task"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(offsets, "_task int, _before long")
    codes = (placed.withColumn("_task", task).join(offsets, "_task")
             .select(col, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).cast("int").alias(out)))
    return df.join(codes, col, "left")


def one_hot(df: DataFrame, col: str, values: list, prefix: str | None = None) -> DataFrame:
    """one 0/1 column per category of a known domain."""
    prefix = prefix or col
    return df.withColumns({one_hot_name(prefix, v): F.when(F.col(col) == F.lit(v), 1).otherwise(0)
                           for v in values})


def one_hot_name(prefix: str, value) -> str:
    return f"{prefix}_" + str(value).replace(" ", "_").replace("-", "_")


# --- Yeo-Johnson (Yeo & Johnson, 2000) ------------------------------------------------------

def yeo_johnson(x: Column, lam: Column) -> Column:
    """psi(x, lambda) for real x."""
    xd = x.cast("double")
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(xd)).otherwise((F.pow(xd + 1.0, lam) - 1.0) / lam)
    neg = F.when(F.abs(lam - 2.0) < 1e-12, -F.log1p(-xd)).otherwise(
        -(F.pow(1.0 - xd, 2.0 - lam) - 1.0) / (2.0 - lam))
    return F.when(xd >= 0, pos).otherwise(neg)


def lambda_grid(lo: float = -3.0, hi: float = 3.0, step: float = 0.01) -> list[float]:
    n = int(round((hi - lo) / step))
    return [round(lo + i * step, 10) for i in range(n + 1)]


def yeo_johnson_loglik(df: DataFrame, cols=NUMERIC_FEATURES, grid: list[float] | None = None) -> DataFrame:
    """Profile log-likelihood of each column at each lambda of the grid.

    llf = -n/2 * log(var(psi)) + (lambda - 1) * sum(sign(x) * log1p(|x|)), with the
    population variance. The grid is a parameter (exploded per row, a fixed replication
    factor); the aggregate is a plain ``groupBy(feature, lambda)``.
    """
    grid = grid or lambda_grid()
    lams = F.explode(F.array(*[F.lit(float(v)) for v in grid])).alias("lam")
    feats = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                for c in cols])).alias("f")
    long = df.select(feats).select("f.*").select("feature", "x", lams)
    psi = yeo_johnson(F.col("x"), F.col("lam"))
    agg = long.groupBy("feature", "lam").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop(psi).alias("var"),
        F.sum(F.signum("x") * F.log1p(F.abs("x"))).alias("slog"))
    return agg.select("feature", F.col("lam").alias("lambda"),
                      (-F.col("n") / 2.0 * F.log("var") + (F.col("lam") - 1.0) * F.col("slog")).alias("loglik"))


def yeo_johnson_fit(df: DataFrame, cols=NUMERIC_FEATURES, grid: list[float] | None = None,
                    widest: float = 200.0) -> DataFrame:
    """F16 fit: the maximum-likelihood lambda per column (ties -> smaller lambda).

    Without a ``grid`` the search starts on [-3, 3] and goes on beyond an end for as long
    as a column's best lambda lies on it; past ``widest`` it is an error, never a bound
    returned as an optimum. Only one row a column comes back from each step.
    """
    best = F.min_by(F.struct("lambda", "loglik"), F.struct(-F.col("loglik"), F.col("lambda")))

    def at(columns, lambdas) -> DataFrame:
        ll = yeo_johnson_loglik(df, columns, lambdas).withColumn("loglik", F.round("loglik", 6))
        return ll.groupBy("feature").agg(best.alias("b")).select("feature", "b.lambda", "b.loglik")

    if grid is not None:
        return at(cols, grid)
    found = {c: None for c in cols}
    lo, hi, todo = -3.0, 3.0, {c: lambda_grid() for c in cols}
    ends = {c: (lo, hi) for c in cols}
    while todo:
        groups: dict[tuple, list[str]] = {}
        for c, lambdas in todo.items():
            groups.setdefault(tuple(lambdas), []).append(c)
        todo = {}
        for lambdas, columns in groups.items():
            for r in at(columns, list(lambdas)).collect():
                c, old = r["feature"], found[r["feature"]]
                if r["lambda"] is not None and (old is None or (-r["loglik"], r["lambda"]) < (-old[1], old[0])):
                    found[c] = (r["lambda"], r["loglik"])
                lo, hi = ends[c]
                if found[c] and found[c][0] in (lo, hi):
                    if max(-lo, hi) >= widest:
                        raise ValueError(f"no best lambda of {c} within [{lo}, {hi}]")
                    up = found[c][0] == hi
                    ends[c] = (lo, hi * 2) if up else (lo * 2, hi)
                    todo[c] = lambda_grid(hi, hi * 2) if up else lambda_grid(lo * 2, lo)
    rows = [(c, *found[c]) for c in cols if found[c]]
    return df.sparkSession.createDataFrame(rows, "feature string, lambda double, loglik double")


def yeo_johnson_transform(df: DataFrame, params: DataFrame, cols=NUMERIC_FEATURES,
                          standardize: bool = True) -> DataFrame:
    """F16 apply: psi(x, lambda) per column, then (optionally) zero mean, unit population
    variance. Lambdas and moments are scalar subqueries."""
    out = df
    for c in cols:
        lam = params.filter(F.col("feature") == c).agg(F.first("lambda")).scalar()
        out = out.withColumn(c, yeo_johnson(F.col(c), lam))
    if standardize:
        mom = out.agg(F.struct(*[x for c in cols for x in (
            F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])).scalar()
        out = out.withColumns({c: F.when(mom[f"s_{c}"] == 0, F.lit(0.0)).otherwise(
            (F.col(c) - mom[f"m_{c}"]) / mom[f"s_{c}"]) for c in cols})
    return out
