"""Session and scratch-space helpers.

Scratch tables (stages, appended tables, checkpoints) live under the shared folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent *and* the
master is local (local runs, tests) do we create a folder of our own and register it as
the checkpoint directory; on a cluster a missing setting is an error, never a
machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "roadrisk",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the session time zone pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private folder is registered only when none is set."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, scratch tables need a "
                           "folder every executor can reach (set spark.checkpoint.dir)")
    local = tempfile.mkdtemp(prefix="roadrisk-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the checkpoint root (never reused)."""
    return os.path.join(checkpoint_root(spark), "roadrisk", f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df, name: str = "stage"):
    """Cut the lineage of a small, bounded intermediate by writing it as a Parquet table in
    the shared checkpoint folder and reading it back.

    One job computes the plan once (an eager RDD checkpoint of an unpersisted plan would
    compute it twice: once for the action, once more to write the checkpoint). Later jobs
    read the table instead of recomputing the plan, and a lost executor costs a re-read,
    not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lies in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table once nothing reads it any more; only what ``scratch_path`` gave."""
    if not path.startswith(os.path.join(checkpoint_root(spark), "roadrisk") + "/"):
        raise ValueError(f"not a scratch path: {path}")
    drop_path(spark, path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In this block, the shuffle files of a job are deleted when it ends. Else they stay until the
    driver collects its garbage, which a load of many jobs doesn't make it do. A result that is
    used again there must be staged: its shuffles would be run again."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
