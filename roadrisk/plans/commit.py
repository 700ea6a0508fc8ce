"""Changes to the months of several stored tables that survive a failure at any moment.

A change names, for each table, the rows that go (by key) and the rows that come. What the
months concerned shall hold is written first, beside the tables (``_commits`` in the store).
The change counts from the moment its manifest is renamed into place: before, the store is
as it was and the folder is dropped by the next writer; after, the staged months are moved
to the tables, and whoever writes next finishes a move that was cut off (``recover``). Every
move can be repeated, and the staged rows stay until all tables have theirs, so no row is
lost in between. Only months that lose rows are replaced; months that only gain rows get
new files beside the old ones. Data is written once: moving is renaming.

One writer at a time works on a store. Readers see a table's month before or after its
move; a report that must not see two tables in different states waits for the writer.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.plans.keys import KeyMarks
from roadrisk.session import drop_path
from roadrisk.sources.files import CODEC

PARTITIONS = ["part_year", "part_month"]
#: The accident that a row of any table belongs to.
OWNER = "FORMULARIO"
FOLDER, MANIFEST = "_commits", "manifest.json"
#: Sums of each month, kept beside the tables (``plans.cells``).
CELLS = "_cells"
_NULL = "__HIVE_DEFAULT_PARTITION__"

Month = tuple[int | None, int | None]


@dataclass
class Change:
    """What becomes of one table: stored rows whose ``key`` is among ``gone`` go, the others of the
    accidents in ``moved`` (FORMULARIO, partition columns) move to that month, and ``new`` rows
    (with partition columns) come."""

    key: str = OWNER
    gone: DataFrame | None = None
    new: DataFrame | None = None
    moved: DataFrame | None = None


def _folder(month: Month) -> str:
    return "/".join(f"{c}={_NULL if v is None else v}" for c, v in zip(PARTITIONS, month))


def folders_of(spark: SparkSession, table: str) -> set[Month]:
    """The months that a table has folders for (from the folder names alone)."""
    fs, p = _fs(spark, table)
    if not fs.exists(p(table)):
        return set()
    value = lambda name: None if name.split("=")[1] == _NULL else int(name.split("=")[1])
    found = set()
    for year in fs.listStatus(p(table)):
        if year.getPath().getName().startswith(f"{PARTITIONS[0]}="):
            for month in fs.listStatus(year.getPath()):
                if month.getPath().getName().startswith(f"{PARTITIONS[1]}="):
                    found.add((value(year.getPath().getName()), value(month.getPath().getName())))
    return found


def drop_cells(spark: SparkSession, store_dir: str, months: Iterable[Month]) -> None:
    """Drop the cells of months that are about to change."""
    root = f"{store_dir.rstrip('/')}/{CELLS}"
    fs, p = _fs(spark, root)
    for month in months:
        fs.delete(p(f"{root}/{_folder(month)}"), True)


def in_months(months: list[Month]) -> Column:
    """Partition filter on a list of months (rows without a month among them)."""
    known = [str(-1 if y is None or m is None else y * 100 + m) for y, m in months]
    return F.expr(f"coalesce(part_year * 100 + part_month, -1) IN ({', '.join(known)})") if known else F.lit(False)


def any_size(staged: DataFrame) -> DataFrame:
    """A staged side of a join that grows with the batch. Its files are many times smaller than
    its rows, so Spark would take it for small and build it in the driver: shuffled instead."""
    return staged.hint("merge")


def months_of(df: DataFrame) -> dict[Month, int]:
    """Rows of each month; a row a month comes to the driver."""
    return {(r[0], r[1]): r["n"] for r in df.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).collect()}


def side_by_side(work: Callable[[str], None], names: Iterable[str], at_once: int = 6) -> None:
    """The jobs of independent tables at the same time, a thread a table."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(work, names))


#: Files of a month from which on its rows are shuffled together again when it is rewritten.
MANY_FILES = 12


class _Concerned:
    """The stored rows that go or move with a change. Bitmaps of its keys keep most other rows out of
    the exact joins."""

    def __init__(self, change: Change):
        self.change = change
        self.marks = [KeyMarks(df, key) for key, df in ((change.key, change.gone), (OWNER, change.moved)) if df is not None]

    def mark(self, rows: DataFrame) -> DataFrame:
        """Rows with ``_may``: whether the change may concern them."""
        names = [f"_may{i}" for i in range(len(self.marks))]
        for name, marks in zip(names, self.marks):
            rows = marks.mark(rows, name)
        return rows.withColumn("_may", reduce(Column.__or__, [F.col(n) for n in names], F.lit(False))).drop(*names)

    def months(self, stored: DataFrame) -> list:
        """(old year and month, new ones, whether the rows stay in the table, their number)."""
        if not self.marks:
            return []
        rows = self.mark(stored.select(*{self.change.key: None, OWNER: None}, *PARTITIONS)).where("_may")
        stays, places = F.lit(True), [F.lit(None).cast("int")] * 2
        if self.change.gone is not None:
            gone = self.change.gone.select(self.change.key).distinct().withColumn("_gone", F.lit(True))
            rows = rows.join(any_size(gone), self.change.key, "left")
            stays = F.col("_gone").isNull()
        if self.change.moved is not None:
            rows = self._moving(rows)
            rows = rows.where(~stays | F.col("_moves"))
            places = [F.when(stays, F.col(f"_new_{c}")).cast("int") for c in PARTITIONS]
        else:
            rows = rows.where(~stays)
        return (rows.groupBy(*PARTITIONS, *[c.alias(f"_to_{n}") for c, n in zip(places, PARTITIONS)], stays.alias("stays"))
                .agg(F.count(F.lit(1)).alias("n")).collect())

    def _moving(self, rows: DataFrame) -> DataFrame:
        moved = self.change.moved.select(OWNER, *[F.col(c).alias(f"_new_{c}") for c in PARTITIONS]).withColumn("_moves", F.lit(True))
        return rows.join(any_size(moved), OWNER, "left")

    def left(self, rows: DataFrame) -> DataFrame:
        """Those of the rows that stay in the table, in the month where they lie from now on."""
        if self.change.gone is not None:
            rows = rows.join(any_size(self.change.gone.select(self.change.key).distinct()), self.change.key, "left_anti")
        if self.change.moved is not None:
            rows = self._moving(rows).withColumns({c: F.when(F.col("_moves"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in PARTITIONS})
        return rows


def _files(fs, p, folder: str) -> int:
    return sum(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p(folder)))


def commit(spark: SparkSession, store_dir: str, changes: dict[str, Change]) -> dict[str, tuple[int, int]]:
    """Apply the changes to all tables; returns (rows gone, rows come) of each."""
    recover(spark, store_dir)
    path = f"{store_dir.rstrip('/')}/{FOLDER}/{uuid.uuid4().hex}"
    plan, counts = {}, {}
    fs, p = _fs(spark, path)

    def stage(name: str) -> None:
        change = changes[name]
        table = f"{store_dir.rstrip('/')}/{name}"
        stored = spark.read.parquet(table)
        concerned = _Concerned(change)
        lose: dict[Month, int] = {}
        gain = dict(months_of(change.new)) if change.new is not None else {}
        for r in concerned.months(stored):
            old, new = (r[0], r[1]), (r[2], r[3])
            lose[old] = lose.get(old, 0) + r["n"]
            if r["stays"]:
                gain[new] = gain.get(new, 0) + r["n"]
        counts[name] = (sum(lose.values()), sum(gain.values()))
        if not lose and not gain:
            return
        crowded = [m for m in lose if _files(fs, p, f"{table}/{_folder(m)}") > MANY_FILES]
        here = concerned.mark(stored.where(in_months(list(lose)))).withColumn("_may", F.col("_may") | in_months(crowded))
        rows = concerned.left(here.where("_may").drop("_may")).select(*stored.columns)
        if change.new is not None:
            rows = rows.unionByName(change.new.select(*stored.columns))
        # rows that nothing concerns are copied from their files, unshuffled
        rows = rows.hint("rebalance", *PARTITIONS).unionByName(here.where("NOT _may").select(*stored.columns))
        rows.write.partitionBy(*PARTITIONS).parquet(f"{path}/{name}", compression=CODEC)
        left = lambda m: m in gain or fs.exists(p(f"{path}/{name}/{_folder(m)}"))
        plan[name] = [[list(m), ("replace" if left(m) else "drop") if m in lose else "add"] for m in sorted({*lose, *gain}, key=str)]

    side_by_side(stage, changes)
    if plan:
        _seal(spark, path, {n: plan[n] for n in changes if n in plan})
        finish(spark, store_dir, path)
    return counts


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    return jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _seal(spark: SparkSession, path: str, plan: dict) -> None:
    """Write the manifest under another name and rename it: it is there whole or not at all."""
    fs, p = _fs(spark, path)
    out = fs.create(p(f"{path}/{MANIFEST}.part"), True)
    out.write(bytearray(json.dumps(plan).encode()))
    out.close()
    fs.rename(p(f"{path}/{MANIFEST}.part"), p(f"{path}/{MANIFEST}"))


def _move(fs, p, source: str, target: str) -> None:
    """Rename a folder or file; a source that is gone was moved before."""
    if fs.exists(p(source)) and not fs.rename(p(source), p(target)):
        raise OSError(f"cannot rename {source} to {target}")


def finish(spark: SparkSession, store_dir: str, path: str) -> None:
    """Move the staged months of a sealed change to the tables; may be run again."""
    fs, p = _fs(spark, path)
    read = fs.open(p(f"{path}/{MANIFEST}"))
    plan = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(read, "UTF-8"))
    read.close()
    drop_cells(spark, store_dir, {tuple(month) for months in plan.values() for month, _ in months})
    for name, months in plan.items():
        for month, what in months:
            source = f"{path}/{name}/{_folder(tuple(month))}"
            target = f"{store_dir.rstrip('/')}/{name}/{_folder(tuple(month))}"
            if what == "drop":
                fs.delete(p(target), True)
            elif what == "replace":
                if fs.exists(p(source)):  # else it was moved before the failure
                    fs.delete(p(target), True)
                    fs.mkdirs(p(os.path.dirname(target)))
                    _move(fs, p, source, target)
            elif fs.exists(p(source)):
                fs.mkdirs(p(target))
                for f in fs.listStatus(p(source)):
                    _move(fs, p, f.getPath().toString(), f"{target}/{f.getPath().getName()}")
    fs.delete(p(f"{path}/{MANIFEST}"), False)  # first, so that a half-deleted stage is never taken for a change
    drop_path(spark, path)


def recover(spark: SparkSession, store_dir: str) -> int:
    """Finish sealed changes and drop the others; returns how many were finished."""
    root = f"{store_dir.rstrip('/')}/{FOLDER}"
    fs, p = _fs(spark, root)
    if not fs.exists(p(root)):
        return 0
    done = 0
    for status in fs.listStatus(p(root)):
        path = status.getPath().toString()
        if fs.exists(p(f"{path}/{MANIFEST}")):
            finish(spark, store_dir, path)
            done += 1
        else:
            drop_path(spark, path)
    return done
