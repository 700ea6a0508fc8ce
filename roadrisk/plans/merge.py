"""The monthly batch as a keyed merge (K5): new rows are added, corrected rows replace what
the store holds, and equal rows change nothing.

Keys are FORMULARIO for accidents and OBJECTID for the rows of a child table. The rows that
a batch has of a key replace the rows that the store has of it (an OBJECTID may stand for
several rows, as child tables have no primary key); with a ``version`` column, only a key's
rows of the greatest version count. A batch with two rows for one accident is rejected. An accident whose date is corrected moves
to its new month with all its child rows, re-pulled or not; a child row that is corrected
to another accident goes to that accident's month. Child rows without an OBJECTID can't be
corrected: of equal ones, as many are added as the store lacks. Child rows of accidents
that neither the store nor the batch knows are left out and counted.

What is read: the batch, the key columns of the stored tables, and the months that hold a
row concerned (the whole table for a batch of a quarter of it or more). What is written: those
months (see ``plans.commit``). Rows are compared by their number and two sums of 48-bit hashes a
key, so their text isn't shuffled. Running a batch twice gives the same store as running it once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions.calendar import previous_month_filter
from roadrisk.functions.cleaning import CLEANERS
from roadrisk.plans.commit import PARTITIONS, Change, commit, in_months, months_of, recover, side_by_side
from roadrisk.plans.commit import any_size as _any_size
from roadrisk.plans.keys import KeyMarks, differing_keys, may_match
from roadrisk.plans.load import check_batch, in_own_month, missing_rows, read_store
from roadrisk.schemas import CHILD_TABLES
from roadrisk.session import drop_scratch, scratch_path
from roadrisk.sources.files import stage_read, stage_write

KEY = "FORMULARIO"


def latest(df: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """The rows of each key's greatest version (null versions come first), without that
    column; all rows if there is none. A key's versions are reduced before the shuffle."""
    if version is None:
        return df
    cols = [c for c in df.columns if c != version]
    top = df.groupBy(F.col(key).alias("_key")).agg(F.max(version).alias("_top"), F.min(version).alias("_least"), F.count(F.lit(1)).alias("_all"), F.count(version).alias("_set"))
    several = top.where("_least <> _top OR _set BETWEEN 1 AND _all - 1").select("_key", "_top")
    # most keys have one version: only rows of the others are shuffled
    if several.isEmpty():
        return df.select(*cols)
    marks = KeyMarks(several.select(F.col("_key").alias(key)), key)
    rows = marks.mark(df, "_may")
    same = F.col(key).eqNullSafe(F.col("_key"))
    kept = rows.where("_may").join(_any_size(several), same, "left").where(F.col("_key").isNull() & F.col("_top").isNull() | F.col(version).eqNullSafe(F.col("_top")))
    return rows.where("NOT _may").select(*cols).unionByName(kept.select(*cols))


def changed_rows(wanted: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of the keys whose rows ``stored`` doesn't hold just as ``wanted`` has them."""
    differ = differing_keys(wanted, stored, key)
    return wanted.join(_any_size(differ), key, "left_semi").select(*wanted.columns)


def _held(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key may be among the keys, from the months that hold one. For a batch of
    much of the table, months and rows aren't looked for before they are compared."""
    if 4 * keys.count() >= stored.count():
        return stored
    found = may_match(stored.select(key, *PARTITIONS), keys, key).join(_any_size(keys.distinct()), key, "left_semi")
    return may_match(stored.where(in_months(list(months_of(found)))), keys, key)


def merge_batch(spark: SparkSession, store_dir: str, accidents_raw: DataFrame, children_raw: dict[str, DataFrame],
                today=None, version: str | None = None) -> dict[str, dict[str, int]]:
    """Merge a batch of raw layers into the store (of the month before ``today``; the whole
    batch when ``today`` is None). Returns, by table, the rows ``replaced`` (moved ones
    included), the rows ``written`` and, of child tables, the ``orphans`` left out."""
    recover(spark, store_dir)
    stage = scratch_path(spark, "merge-stage")
    try:
        acc = CLEANERS["siniestros"](accidents_raw)
        if today is not None:
            acc = previous_month_filter(acc, today)
        stage_write(in_own_month(latest(acc, KEY, version)), stage, "batch")
        batch = stage_read(spark, stage, "batch")

        def stage_child(child: str) -> None:
            rows = CLEANERS[child](children_raw[child])
            keyed = latest(rows.where("OBJECTID IS NOT NULL"), "OBJECTID", version)
            free = rows.where("OBJECTID IS NULL").select(*keyed.columns)
            stage_write(keyed.unionByName(free), stage, child)

        side_by_side(stage_child, children_raw)
        kids = {c: stage_read(spark, stage, c) for c in children_raw}
        stored = read_store(spark, store_dir, partitions=True)

        # the batch's rows by accident; where every accident of the batch lies and where it shall lie
        number = lambda n: [F.lit(int(n == c)).alias(c) for c in kids]
        rows = reduce(DataFrame.union, [df.select(KEY, *number(n)) for n, df in (("siniestros", batch), *kids.items())])
        stage_write(rows.groupBy(KEY).agg(*[F.sum(c).alias(c) for c in kids]), stage, "named")
        named = stage_read(spark, stage, "named")
        known = stored["siniestros"].select(KEY, *PARTITIONS).join(_any_size(named), KEY, "left_semi")
        old, new = [f"old_{p}" for p in PARTITIONS], [f"new_{p}" for p in PARTITIONS]
        place = (known.toDF(KEY, *old).withColumn("stored", F.lit(True))
                 .join(batch.select(KEY, *PARTITIONS).toDF(KEY, *new).withColumn("pulled", F.lit(True)), KEY, "full"))
        place = place.select(KEY, "stored", "pulled", *old,
                             *[F.when(F.col("pulled"), F.col(n)).otherwise(F.col(o)).alias(p) for o, n, p in zip(old, new, PARTITIONS)])
        stage_write(place, stage, "place")
        place = stage_read(spark, stage, "place")
        stays = reduce(Column.__and__, [F.col(o).eqNullSafe(F.col(p)) for o, p in zip(old, PARTITIONS)])
        stage_write(place.where(F.col("stored") & F.col("pulled") & ~stays).select(KEY, *PARTITIONS), stage, "moved")
        moved = stage_read(spark, stage, "moved")
        still = moved.isEmpty()

        here = _held(stored["siniestros"], batch.select(KEY), KEY)
        stage_write(changed_rows(batch, here, KEY), stage, "new-siniestros")
        fresh = stage_read(spark, stage, "new-siniestros")
        changes = {"siniestros": Change(KEY, fresh, fresh) if not fresh.isEmpty() else Change()}
        lost = named.join(_any_size(place.select(KEY)), KEY, "left_anti").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kids]).first()
        orphans = {c: int(lost[c]) for c in kids}

        def child_change(child: str) -> None:
            rows = kids[child]
            lies = rows.columns
            changes[child] = Change("OBJECTID", moved=None if still else moved)
            if rows.isEmpty():
                return
            # a child row lies where its accident does, so that months needn't be compared
            keyed, free = rows.where("OBJECTID IS NOT NULL"), rows.where("OBJECTID IS NULL")
            here = _held(stored[child], keyed.select("OBJECTID"), "OBJECTID")
            stage_write(differing_keys(keyed, here.where("OBJECTID IS NOT NULL"), "OBJECTID"), stage, f"differ-{child}")
            differ = stage_read(spark, stage, f"differ-{child}")
            none, no_free = differ.isEmpty(), free.isEmpty()
            if none and no_free:
                return
            fresh = keyed.limit(0) if none else may_match(keyed, differ, "OBJECTID").join(_any_size(differ), "OBJECTID", "left_semi")
            if not no_free:
                # rows without an id: what the store lacks, counted where their accident's rows lie now
                held = (stored[child].where("OBJECTID IS NULL").join(_any_size(free.select(KEY).distinct()), KEY, "left_semi"))
                placed = free.join(_any_size(place.select(KEY)), KEY).select(*lies)
                fresh = fresh.select(*lies).unionByName(missing_rows(placed, held.select(*lies)))
            placed = fresh.join(_any_size(place.select(KEY, *PARTITIONS)), KEY).select(*lies, *PARTITIONS)
            stage_write(placed, stage, f"all-{child}")
            new = stage_read(spark, stage, f"all-{child}")
            if not new.isEmpty():
                changes[child].gone, changes[child].new = new.where("OBJECTID IS NOT NULL"), new

        side_by_side(child_change, kids)
        come = {n: c.new.drop(*PARTITIONS) for n, c in changes.items() if c.new is not None}
        if come:
            check_batch(come)
        # children first: their accident is there before or comes with the same change
        counts = commit(spark, store_dir, {n: changes[n] for n in [*children_raw, "siniestros"]})
        return {n: {"replaced": counts[n][0], "written": counts[n][1]} | ({"orphans": orphans[n]} if n in orphans else {})
                for n in counts}
    finally:
        drop_scratch(spark, stage)


def delete_accidents(spark: SparkSession, store_dir: str, doomed: DataFrame) -> dict[str, int]:
    """K4: delete accidents (by FORMULARIO) and all their child rows from the store; returns
    the rows deleted by table. Only the months of these rows are rewritten, and a delete that
    is cut off is finished by the next writer."""
    recover(spark, store_dir)
    stage = scratch_path(spark, "delete-stage")
    try:
        keys = read_store(spark, store_dir)["siniestros"].select(KEY).join(doomed.select(KEY).distinct(), KEY, "left_semi")
        stage_write(keys, stage, "keys")
        keys = stage_read(spark, stage, "keys")
        counts = commit(spark, store_dir, {n: Change(KEY, keys) for n in [*CHILD_TABLES, "siniestros"]})
        return {n: gone for n, (gone, _) in counts.items()}
    finally:
        drop_scratch(spark, stage)
