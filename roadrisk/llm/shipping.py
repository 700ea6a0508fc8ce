"""Make the package importable in Python workers, wherever the driver was started.

Tasks refer to functions of this package by name. Where it isn't installed on the
executors, a zip of its sources in the shared scratch folder is added to the session once.
"""

from __future__ import annotations

import functools
import io
import os
import zipfile
from collections.abc import Callable

import roadrisk
from pyspark.sql import SparkSession

from roadrisk.session import scratch_path


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files (once a session)."""
    sc = spark.sparkContext
    if getattr(sc, "_roadrisk_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(roadrisk.__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("roadrisk", os.path.relpath(path, root)))
    target = scratch_path(spark, "sources") + ".zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(target)
    sc._roadrisk_shipped = True


def shipped(fn: Callable) -> Callable:
    """A query or stage whose first argument is the session, with the sources shipped first."""
    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kw):
        ship(spark)
        return fn(spark, *args, **kw)
    return run
