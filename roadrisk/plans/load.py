"""Loads: the initial bulk load (R4) and the idempotent monthly append (K5). Corrections of
stored rows (K5) and deletes (K4) are in ``plans.merge``.

R4:  landed page folders -> read (S1) -> cleaning (F1-F8), accidents staged first -> children
     joined to the staged accident keys (J5) -> integrity checks (K1, K3) -> one write a table (S6).
K5:  accidents of the batch (P8) staged -> split into new and already stored ones by the whole
     stored key column -> their child rows (J6) minus the rows the store holds -> staged (S7)
     -> checks -> append.

Stored tables hold the columns of the cleaned tables as they are. Two further columns,
``part_year`` and ``part_month``, say in which month's partition a row lies: its
accident's, also for child rows, so a date window prunes the partitions of all six tables.
An accident without a date, and its child rows, lie in the null partition.

The integrity checks run *before* any write and raise on a violation, so a bad batch
leaves the store untouched. The append adds nothing twice: an accident's key is looked up
among all stored keys whatever its month (a correction of a stored accident is
``plans.merge.merge_batch``'s work), and of equal child rows only as many are added as the
store lacks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions.calendar import as_date, previous_month_filter, window_start
from roadrisk.functions.cleaning import CLEANERS
from roadrisk.operators.integrity import pk_violations
from roadrisk.schemas import ALL_TABLES, CHILD_TABLES, VARCHAR_LIMITS
from roadrisk.plans.commit import PARTITIONS, drop_cells, in_months, months_of, recover, side_by_side
from roadrisk.plans.keys import may_match, row_hash
from roadrisk.session import drop_scratch, scratch_path
from roadrisk.sources.files import (CODEC, append_table, bad_pages, flatten_pages, land_pages, read_pages,
                                    stage_read, stage_write)


class IntegrityError(RuntimeError):
    pass


def check_batch(tables: dict[str, DataFrame]) -> dict[str, int]:
    """K1 on the accidents (if the batch has any) and K3 on every table, plus the row count of every table, all
    evaluated together in one job; raises ``IntegrityError`` when anything is violated.
    Returns {"pk": n, "length:<table>": n, "rows:<table>": n}."""
    parts = []
    if "siniestros" in tables:
        parts.append(pk_violations(tables["siniestros"].select("FORMULARIO"))
                     .agg(F.count(F.lit(1)).alias("n")).select(F.lit("pk").alias("check"), "n"))
    for name, df in tables.items():
        # one scan per table: row count and the K3 violations of every limited column
        viol = None
        for c, n in VARCHAR_LIMITS[name].items():
            v = F.count_if(F.length(c) > n)
            viol = v if viol is None else viol + v
        one = df.agg(F.count(F.lit(1)).alias("rows"), viol.alias("viol"))
        parts.append(one.select(F.explode(F.array(
            F.struct(F.lit(f"length:{name}").alias("check"), F.col("viol").alias("n")),
            F.struct(F.lit(f"rows:{name}").alias("check"), F.col("rows").alias("n")))).alias("e"))
            .select("e.check", "e.n"))
    found = {r.check: int(r.n) for r in reduce(DataFrame.unionByName, parts).collect()}
    bad = {k: v for k, v in found.items() if v and not k.startswith("rows:")}
    if bad:
        raise IntegrityError(f"batch rejected: {bad}")
    return found


def in_own_month(accidents: DataFrame) -> DataFrame:
    """Accidents with their partition columns."""
    return accidents.withColumns({"part_year": F.col("ANO_OCURRENCIA_ACC"), "part_month": F.col("MES_NRO_OCURRENCIA_ACC")})


def with_accident_month(child: DataFrame, accidents: DataFrame) -> DataFrame:
    """Child rows of known accidents (J5/J6) with their accident's partition columns; the
    child's own columns stay as they are."""
    if not set(PARTITIONS) <= set(accidents.columns):
        accidents = in_own_month(accidents)
    return child.join(accidents.select("FORMULARIO", *PARTITIONS), "FORMULARIO").select(*child.columns, *PARTITIONS)


def write_store(tables: dict[str, DataFrame], store_dir: str, mode: str = "overwrite",
                made_of: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, str]:
    """Write the tables partitioned by the accident's month.

    REBALANCE lets AQE group rows by partition -- few files per month -- while still
    splitting a month that is too large for one task. Child rows given as the narrow rows
    they are made of are turned into the table's own by ``made_of`` only after that shuffle.
    """
    paths = {name: f"{store_dir.rstrip('/')}/{name}" for name in tables}

    def write(name: str) -> None:
        df = tables[name]
        if name == "siniestros" and "part_year" not in df.columns:
            df = in_own_month(df)
        df = df.hint("rebalance", *PARTITIONS)
        if made_of is not None and name in CHILD_TABLES:
            df = made_of(name, df)
        df.write.mode(mode).partitionBy(*PARTITIONS).parquet(paths[name], compression=CODEC)

    # two at once: one table's last tasks leave no core idle, and few shuffles are on disk together
    side_by_side(write, tables, 2)
    return paths


def months_between(start, end) -> Column:
    """Partition filter: months that a date after ``start`` and up to ``end`` can lie in."""
    a, z = as_date(start), as_date(end)
    month = F.col("part_year") * 12 + F.col("part_month")
    return (month >= a.year * 12 + a.month) & (month <= z.year * 12 + z.month)


def read_store(spark: SparkSession, store_dir: str, partitions: bool = False) -> dict[str, DataFrame]:
    """The stored tables; with their partition columns on request."""
    found = {n: spark.read.parquet(f"{store_dir.rstrip('/')}/{n}") for n in ALL_TABLES}
    return found if partitions else {n: df.drop(*PARTITIONS) for n, df in found.items()}


class StoreTables:
    """The tables of a store for the reports, with the interface of ``Tables``.

    With a window, only the partitions it can touch are read, of accidents and child
    tables alike; the reports' own date filter still cuts the first and last month.
    """

    def __init__(self, spark: SparkSession, store_dir: str, grid: DataFrame, end=None, years: int = 3):
        self.spark, self.grid = spark, grid
        keep = None if end is None else months_between(window_start(as_date(end), years), end)
        self._tables = {n: (df if keep is None else df.where(keep)).drop(*PARTITIONS)
                        for n, df in read_store(spark, store_dir, partitions=True).items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self.grid if name == "malla" else self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in ALL_TABLES:
            return self._tables[name]
        raise AttributeError(name)


def land_layers(raw: dict[str, DataFrame], landing_dir: str) -> dict[str, str]:
    paths = {}
    for layer, df in raw.items():
        paths[layer] = f"{landing_dir.rstrip('/')}/{layer}"
        land_pages(df, paths[layer], layer)
    return paths


class BadPages(RuntimeError):
    """Landed pages that can't be loaded."""


def _observed(seen: Observation, pages: DataFrame, name: str, what: Column) -> int:
    """An observed count; counted anew where Spark left the observed part of a plan out
    (because nothing could come of it)."""
    try:
        return seen.get[name]
    except Exception:  # no metrics arrived
        return pages.agg(what).first()[0]


def initial_load(spark: SparkSession, landing: dict[str, str], store_dir: str, multiline: bool = False,
                 quarantine: str | None = None) -> dict[str, dict[str, int]]:
    """Read the landed page folders (layer -> path), keep known children, clean, check,
    write all six tables. Returns, by table, the rows stored, the child rows dropped because
    their accident is unknown, and the bad pages.

    Every page is parsed once: the cleaned accidents are staged first and the children join
    the staged keys; the checks and the store read the stage. Bad pages (see ``checked_pages``)
    are counted while a layer is staged. Any of them stops the load before the store is
    written (``BadPages`` with files and reasons), unless ``quarantine`` names a folder: then
    they are listed there with file, reason and text, and the good pages are loaded.
    """
    stage = scratch_path(spark, "load-stage")
    bad_one = F.count_if(F.col("reason").isNotNull())
    try:
        pages = {layer: read_pages(spark, p, layer, multiline) for layer, p in landing.items()}
        seen = {layer: Observation() for layer in landing}
        good = {layer: flatten_pages(df.observe(seen[layer], bad_one.alias("bad")).where("reason IS NULL"), layer)
                for layer, df in pages.items()}
        stage_write(in_own_month(CLEANERS["siniestros"](good["siniestros"])), stage, "siniestros")
        accidents = stage_read(spark, stage, "siniestros")
        read = {}
        for child in CHILD_TABLES:
            read[child] = Observation()
            rows = CLEANERS[child](good[child]).observe(read[child], F.count(F.lit(1)).alias("n"))
            stage_write(with_accident_month(rows, accidents), stage, child)
        bad = {layer: _observed(seen[layer], pages[layer], "bad", bad_one) for layer in landing}
        if any(bad.values()):
            listed = reduce(DataFrame.unionByName, [bad_pages(spark, landing[n], n, multiline) for n, k in bad.items() if k])
            if quarantine is None:
                some = listed.select("layer", "file", "reason").limit(20).collect()
                raise BadPages(f"{sum(bad.values())} bad pages, nothing stored: " + "; ".join(f"{r.layer} {r.file}: {r.reason}" for r in some))
            listed.write.mode("append").parquet(quarantine)
        staged = {name: stage_read(spark, stage, name) for name in ALL_TABLES}
        found = check_batch(staged)
        write_store(staged, store_dir)
    finally:
        drop_scratch(spark, stage)
    stored = {n: found[f"rows:{n}"] for n in ALL_TABLES}
    return {"rows": stored, "bad_pages": bad,
            "orphans": {c: _observed(read[c], CLEANERS[c](good[c]), "n", F.count(F.lit(1))) - stored[c] for c in CHILD_TABLES}}


def missing_rows(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``wanted`` that ``held`` lacks, equal rows by number: of n equal rows wanted
    and m held, n - m come back. Both sides are counted before they meet."""
    cols = wanted.columns
    want = wanted.groupBy(*cols).agg(F.count(F.lit(1)).alias("_want"))
    have = held.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_have")).toDF(*[f"_h_{c}" for c in cols], "_have")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in cols])
    lacking = F.greatest(F.col("_want") - F.coalesce("_have", F.lit(0)), F.lit(0)).cast("int")
    return (want.join(have, same, "left").withColumn("_n", lacking).where("_n > 0")
            .select(*cols, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).drop("_i"))


def _append_staged(spark: SparkSession, stage: str, store_dir: str, names: list[str]) -> dict[str, int]:
    """Check the staged batch as a whole, then append table by table (accidents last)."""
    staged = {name: stage_read(spark, stage, name) for name in names}
    found = check_batch(staged)
    counts = {name: found[f"rows:{name}"] for name in names}
    months = [months_of(staged[name]) for name in names if counts[name]]
    drop_cells(spark, store_dir, {m for found_ in months for m in found_})
    for name in sorted(names, key=ALL_TABLES.index, reverse=True):
        if counts[name]:
            append_table(staged[name], f"{store_dir.rstrip('/')}/{name}", PARTITIONS)
    return counts


def _row_sums(rows: DataFrame) -> DataFrame:
    """By accident, the number of its rows and two sums of 48-bit hashes of their values and nulls
    (null where a sum is too large, which then equals nothing)."""
    total = lambda seed: F.try_sum(row_hash(seed, rows.columns))
    return rows.groupBy("FORMULARIO").agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))


def stage_differing(spark: SparkSession, stage: str, name: str, wanted: DataFrame, held: DataFrame,
                    sums: DataFrame | None = None) -> DataFrame:
    """FORMULARIO of the accidents that don't have the same rows in ``wanted`` and ``held``. Both
    sides are summed by accident before they are shuffled, the stored one only for accidents of
    the batch; rows that add up to the same number and the same two 48-bit sums count as the same."""
    stage_write(_row_sums(wanted), stage, f"sums-{name}")
    mine = stage_read(spark, stage, f"sums-{name}")
    theirs = held.select(*wanted.columns) if sums is None else sums
    # a bitmap keeps nothing out where the batch has most of the table
    if (2 * mine.count() if sums is not None else 2 * (mine.agg(F.sum("n")).first()[0] or 0)) < theirs.count():
        theirs = may_match(theirs, mine.select("FORMULARIO"))
    theirs = (_row_sums(theirs) if sums is None else theirs).toDF("FORMULARIO", "hn", "ha", "hb")
    same = (F.col("n") == F.col("hn")) & (F.col("a") == F.col("ha")) & (F.col("b") == F.col("hb"))
    return mine.join(theirs, "FORMULARIO", "left").where(~F.coalesce(same, F.lit(False))).select("FORMULARIO")


def _stage_children(spark: SparkSession, stage: str, store_dir: str, children: dict[str, DataFrame], keys: DataFrame) -> None:
    """Stage the cleaned child rows of the keyed accidents (FORMULARIO, partition) that the store lacks.
    Of the store, the months of these accidents are read."""
    stored = read_store(spark, store_dir, partitions=True)
    on = [F.col("s.FORMULARIO") == F.col("k.FORMULARIO"), *(F.col(f"s.{p}").eqNullSafe(F.col(f"k.{p}")) for p in PARTITIONS)]
    here = in_months(list(months_of(keys)))

    def stage_child(child: str) -> None:
        wanted = with_accident_month(may_match(CLEANERS[child](children[child]), keys), keys)
        held = may_match(stored[child].where(here), keys).alias("s").join(keys.alias("k"), reduce(Column.__and__, on), "left_semi")
        stage_write(missing_rows(wanted, held), stage, child)

    side_by_side(stage_child, children, 2)


def incremental_append(spark: SparkSession, store_dir: str, accidents_raw: DataFrame,
                       children_raw: dict[str, DataFrame], today=None) -> dict[str, int]:
    """K5: append one month (the month before ``today``; all rows when ``today`` is None).
    Returns the rows added by table."""
    recover(spark, store_dir)
    stage = scratch_path(spark, "month-stage")
    try:
        acc = CLEANERS["siniestros"](accidents_raw)
        if today is not None:
            acc = previous_month_filter(acc, today)
        stage_write(in_own_month(acc), stage, "batch")
        batch = stage_read(spark, stage, "batch")
        known = read_store(spark, store_dir, partitions=True)["siniestros"].select("FORMULARIO", *PARTITIONS)
        stage_write(batch.join(known, "FORMULARIO", "left_anti"), stage, "siniestros")
        new = stage_read(spark, stage, "siniestros")
        # child rows go where their accident lies: stored ones keep their partition
        again = known.join(batch.select("FORMULARIO"), "FORMULARIO", "left_semi")
        stage_write(new.select("FORMULARIO", *PARTITIONS).union(again), stage, "keys")
        _stage_children(spark, stage, store_dir, children_raw, stage_read(spark, stage, "keys"))
        return _append_staged(spark, stage, store_dir, ["siniestros", *children_raw])
    finally:
        drop_scratch(spark, stage)


def stage_stored_sums(spark: SparkSession, store_dir: str, child: str, raw: DataFrame, path: str) -> DataFrame:
    """Sums of a stored child table by accident, for several batches of ``raw`` to be compared with."""
    cols = CLEANERS[child](raw).columns
    stage_write(_row_sums(read_store(spark, store_dir)[child].select(*cols)), path, child)
    return stage_read(spark, path, child)


def append_late_children(spark: SparkSession, store_dir: str, children_raw: dict[str, DataFrame],
                         sums: dict[str, DataFrame] | None = None) -> dict[str, int]:
    """K5: child rows that came after their accident was stored. Rows of accidents that
    aren't stored are left for the accident's own append. Only accidents whose rows aren't
    those that the store has are compared row by row (``sums``: see ``stage_differing``)."""
    recover(spark, store_dir)
    stage = scratch_path(spark, "late-stage")
    try:
        stored = read_store(spark, store_dir, partitions=True)
        differ = reduce(DataFrame.union, [stage_differing(spark, stage, c, CLEANERS[c](raw), stored[c], (sums or {}).get(c)) for c, raw in children_raw.items()])
        stage_write(stored["siniestros"].select("FORMULARIO", *PARTITIONS).join(differ, "FORMULARIO", "left_semi"), stage, "keys")
        keys = stage_read(spark, stage, "keys")
        if keys.isEmpty():
            return dict.fromkeys(children_raw, 0)
        _stage_children(spark, stage, store_dir, children_raw, keys)
        return _append_staged(spark, stage, store_dir, list(children_raw))
    finally:
        drop_scratch(spark, stage)


def store_counts(spark: SparkSession, store_dir: str) -> DataFrame:
    """Rows per stored table (table_name, rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in read_store(spark, store_dir).items()]
    return reduce(DataFrame.unionByName, parts)


def content_sql_column(name: str, kind: str) -> str:
    """A column as text that any SQL engine writes alike: numbers in thousandths, times in ms."""
    c = f"`{name}`"
    if kind == "double":
        c = f"cast(round({c} * 1000) AS bigint)"
    elif kind == "timestamp":
        c = f"unix_millis({c})"
    return f"coalesce(cast({c} AS string), '~')"


def store_content(spark: SparkSession, store_dir: str) -> DataFrame:
    """Per stored table: its rows, and the sum of a hash of every row's own columns (in
    name order), which doesn't depend on the order of rows."""
    parts = []
    for n, df in read_store(spark, store_dir).items():
        text = ", ".join(content_sql_column(c, t) for c, t in sorted(df.dtypes))
        h = f"cast(conv(substr(md5(concat_ws('|', {text})), 1, 8), 16, 10) AS bigint)"
        parts.append(df.selectExpr(f"{h} AS h").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("h"), F.lit(0)).alias("content"))
                     .select(F.lit(n).alias("table_name"), "rows", "content"))
    return reduce(DataFrame.unionByName, parts)
