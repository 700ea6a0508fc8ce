"""Token files: the ids of whole documents in Parquet, one list column and its metadata.

Layout: documents in ascending id order over range-partitioned files, ids as a Parquet
list of 32-bit integers with dictionary encoding (format version 2, so a page whose
dictionary would not pay is delta encoded), row groups and pages of stated sizes and the
page index that the writer adds. ``part``, ``part_start`` and ``n_tokens`` say where a
document's ids lie in the stream of all ids, so metadata reads never touch the id pages
and a read of chosen documents skips row groups and pages by the range of their ids.

Defined cases: a null or empty text has the end id alone; rows that share an id stay rows
of their own, in the order of their texts' hashes; a null id comes first; an empty table
writes an empty set of files; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.bpe import encoder
from roadrisk.session import scratch_path

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, row_group_bytes: int = ROW_GROUP_BYTES,
                 page_bytes: int = PAGE_BYTES) -> None:
    """Encode every document and write the token files."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("part", T.IntegerType()),
                           T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        from pyspark import TaskContext
        enc, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi, ids, offsets in enc.columns(b.column(1), end_id):  # bounded output batches
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view("<i4")))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array([part] * (hi - lo), pa.int32()),
                                       pa.array(at + offsets[:-1]), pa.array(np.diff(offsets)), lists],
                                      names=schema.fieldNames())
                at += int(offsets[-1])

    cols = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    in_order = (cols.repartitionByRange(F.col(id_col).asc_nulls_first(), F.xxhash64("__text"))
                .sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.xxhash64("__text")))
    (in_order.mapInArrow(run, schema).write.mode("errorifexists")
     .option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "true")
     .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(page_bytes))
     .option("compression", "zstd").parquet(path))


def read_metadata(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, part, part_start, n_tokens, start) without reading any ids; ``start`` is the
    number of ids of all documents before."""
    meta = spark.read.parquet(path).select(id_col, "part", "part_start", "n_tokens")
    return meta.join(_part_starts(meta), "part").withColumn("start", F.col("base") + F.col("part_start")).drop("base")


def _part_starts(meta: DataFrame) -> DataFrame:
    """Ids in the files before each file (one row a file)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
            .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "base"))


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids) of all documents, or of those asked for (the filter reaches the scan)."""
    df = spark.read.parquet(path).select(id_col, "n_tokens", "ids")
    return df if doc_ids is None else df.where(F.col(id_col).isin(list(doc_ids)))


def digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, read back from the files: id, start, n_tokens (ids counted), ids_crc32."""
    files = spark.read.parquet(path).select(id_col, "part", "part_start", "ids")
    schema = T.StructType([files.schema[id_col], T.StructField("part", T.IntegerType()),
                           T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for b in batches:
            lists = b.column(3)
            off = lists.offsets.to_numpy()
            ids = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            crc = [zlib.crc32(ids[a:z]) for a, z in zip(off, off[1:])]
            yield pa.record_batch([*b.columns[:3], pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
                                  names=schema.fieldNames())

    return (files.mapInArrow(run, schema)
            .join(_part_starts(spark.read.parquet(path).select("part", "n_tokens")), "part")
            .select(id_col, (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, **kw) -> str:
    """Write the token files to a fresh folder under the shared scratch folder; its path."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **kw)
    return path
