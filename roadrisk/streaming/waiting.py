"""The monthly delivery as two streams, with child rows that wait in state for their accident.

Pages of all layers land in one folder each, in any order. The *intake* parses every page
once: bad pages are set aside with file and reason, accidents and the child rows of known
accidents (stored, or in the same micro-batch) are merged into the store, corrections
included, and the other child rows are handed on, parsed. The *waiting* stream joins
those rows with the accidents that the intake merges later: a stream-stream join whose
state holds a child row until its accident comes or ``patience`` has passed by the landing
times; its watermarks free the state. Rows that waited in vain are looked up in the store once
more, and listed if their accident isn't there. Of several versions of a row, the one that
landed last counts.

A delivery runs the intake to its end, then the waiting stream. Both can be stopped and
replayed at any point: a micro-batch writes to a folder of its own number, and merging the
same rows again changes nothing. An accident that is delivered again within ``patience``
wakes no row a second time.

    landing/<layer> --intake--> store, <work>/bad, <work>/keys, <work>/waiting
    <work>/waiting x <work>/keys --waiting--> store, <work>/unmatched
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.plans.commit import OWNER, any_size
from roadrisk.plans.keys import KeyMarks, may_match
from roadrisk.plans.load import read_store
from roadrisk.plans.merge import merge_batch
from roadrisk.schemas import ALL_TABLES, BAD_FIELD, CHILD_TABLES, ERROR_FIELD, GEOMETRY_LAYERS, RAW_ATTRIBUTES, checked_page_schema
from roadrisk.session import drop_scratch, scratch_path, shuffles_dropped
from roadrisk.sources.files import checked_pages, stage_read, stage_write

PATIENCE = "40 days"
BAD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("layer", "file", "reason", "detail")])


def row_schema(layer: str) -> T.StructType:
    """A flat raw row of a layer."""
    xy = [T.StructField(c, T.DoubleType()) for c in ("x", "y")] if layer in GEOMETRY_LAYERS else []
    return T.StructType([*RAW_ATTRIBUTES[layer], *xy])


KEY_SCHEMA = T.StructType([T.StructField("FORMULARIO", T.StringType()), T.StructField("landed", T.TimestampType())])
WAITING_SCHEMA = T.StructType([*KEY_SCHEMA.fields, *(T.StructField(c, row_schema(c)) for c in CHILD_TABLES)])


def _layer_rows(spark: SparkSession, landing: str, layer: str, files: int) -> DataFrame:
    """A layer's landing as a stream of one shape: a feature (in the layer's column) or a bad page."""
    pages = (spark.readStream.schema(checked_page_schema(layer)).option("columnNameOfCorruptRecord", BAD_FIELD)
             .option("maxFilesPerTrigger", files).json(f"{landing}/{layer}")
             .withColumns({"file": F.col("_metadata.file_path"), "landed": F.col("_metadata.file_modification_time")}))
    pages = checked_pages(pages)
    none = F.array(F.lit(None).cast(pages.schema["features"].dataType.elementType))
    f = pages.select("file", "landed", "reason", F.coalesce(ERROR_FIELD, BAD_FIELD).alias("detail"),
                     F.explode(F.when(F.col("reason").isNull(), F.col("features")).otherwise(none)).alias("f"))
    cols = [F.col(f"f.attributes.{a.name}").alias(a.name) for a in RAW_ATTRIBUTES[layer]]
    if layer in GEOMETRY_LAYERS:
        cols += [F.col("f.geometry.x").alias("x"), F.col("f.geometry.y").alias("y")]
    bad = F.struct(F.lit(layer).alias("layer"), "file", "reason", "detail").cast(BAD_SCHEMA)
    return f.select("landed", F.when(F.col("reason").isNotNull(), bad).alias("bad"),
                    F.when(F.col("reason").isNull(), F.struct(*cols)).alias(layer))


def _of(batch: DataFrame, layer: str) -> DataFrame:
    """A layer's raw rows with the time that they landed, their version."""
    return batch.where(F.col(layer).isNotNull()).select(f"{layer}.*", "landed")


def _split(rows: DataFrame, unknown: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Child rows of unknown accidents (without an accident's id among them), with all layers in one
    frame, and the others by layer. Only rows that may be of unknown accidents are shuffled."""
    named = unknown.select(F.col(OWNER).alias("_owner"))
    none, marks = unknown.isEmpty(), KeyMarks(unknown, OWNER)

    def parted(df: DataFrame, how: str) -> DataFrame:
        return df.where("_may").join(any_size(named), F.col(OWNER).eqNullSafe(F.col("_owner")), how).drop("_may")

    owner = F.coalesce(*(F.col(f"{c}.{OWNER}") for c in CHILD_TABLES))
    children = rows.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in CHILD_TABLES])).withColumn(OWNER, owner)
    children = children.select(*WAITING_SCHEMA.fieldNames())
    if none:
        return children.limit(0), {c: _of(rows, c) for c in CHILD_TABLES}
    marked = {c: marks.mark(_of(rows, c), "_may") for c in CHILD_TABLES}
    here = {c: df.where("NOT _may").drop("_may").unionByName(parted(df, "left_anti")) for c, df in marked.items()}
    return parted(marks.mark(children, "_may"), "left_semi"), here


def _numbered(work: str, what: str, epoch: int) -> str:
    return f"{work}/{what}/batch={epoch}"


def start_intake(spark: SparkSession, landing: str, store_dir: str, work: str, files_per_trigger: int = 100):
    """Start the stream of landed pages (six folders under ``landing``); it ends with what has
    landed so far."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [_layer_rows(spark, landing, layer, files_per_trigger) for layer in ALL_TABLES])

    def body(batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        with shuffles_dropped(s):
            take(s, batch, epoch)

    def take(s: SparkSession, batch: DataFrame, epoch: int) -> None:
        path = scratch_path(spark, "intake")
        stage_write(batch, path, "rows")  # the one pass over the pages
        rows = s.read.schema(batch.schema).parquet(f"{path}/rows")
        accidents = _of(rows, "siniestros")
        known = read_store(s, store_dir)["siniestros"].select(OWNER).union(accidents.select(OWNER))
        owners = reduce(DataFrame.union, [_of(rows, c).select(OWNER) for c in CHILD_TABLES]).distinct()
        stage_write(owners.join(any_size(known), OWNER, "left_anti"), path, "unknown")
        unknown = stage_read(s, path, "unknown")
        waits, here = _split(rows, unknown)
        waits.write.mode("overwrite").parquet(_numbered(work, "waiting", epoch))
        rows.where("bad IS NOT NULL").select("bad.*").write.mode("overwrite").parquet(_numbered(work, "bad", epoch))
        merge_batch(s, store_dir, accidents, here, version="landed")
        # only now that the accidents are stored may the rows that wait for them go on
        keys = rows.where("siniestros IS NOT NULL").groupBy("siniestros.FORMULARIO").agg(F.max("landed").alias("landed"))
        keys.write.mode("overwrite").parquet(_numbered(work, "keys", epoch))
        drop_scratch(s, path)

    return (rows.writeStream.foreachBatch(body).option("checkpointLocation", f"{work}/checkpoint-intake")
            .trigger(availableNow=True).start())


def start_waiting(spark: SparkSession, store_dir: str, work: str, patience: str = PATIENCE, files_per_trigger: int = 100):
    """Start the stream of child rows that wait for their accident."""
    def source(what: str, schema: T.StructType) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{work}/{what}/batch=*")

    child = source("waiting", WAITING_SCHEMA).withWatermark("landed", "1 hour").alias("c")
    key = (source("keys", KEY_SCHEMA).toDF("k_formulario", "k_landed").withWatermark("k_landed", patience)
           .dropDuplicatesWithinWatermark(["k_formulario"]).alias("k"))
    # an accident that landed a little earlier than its child may still be merged after it
    joined = child.join(key, F.expr(f"c.FORMULARIO = k.k_formulario AND k.k_landed >= c.landed - INTERVAL {patience} "
                                    f"AND k.k_landed <= c.landed + INTERVAL {patience}"), "leftOuter")

    def body(batch: DataFrame, epoch: int) -> None:
        path = scratch_path(spark, "waited")
        stage_write(batch, path, "rows")
        # in the caller's session: that of a stream with state has no adaptive execution, so every join
        # of the merge would have all its shuffle partitions, however few rows they hold
        with shuffles_dropped(spark):
            merge_waited(spark.read.schema(batch.schema).parquet(f"{path}/rows"), epoch)
        drop_scratch(spark, path)

    def merge_waited(rows: DataFrame, epoch: int) -> None:
        none = rows.isEmpty()  # a batch that only moves the watermark changes nothing
        vain = rows.where("k_formulario IS NULL")
        if not none:
            known = may_match(read_store(spark, store_dir)["siniestros"].select(OWNER), vain.select(OWNER))
            vain = vain.join(any_size(known), OWNER, "left_anti")
        vain.select(*WAITING_SCHEMA.fieldNames()).write.mode("overwrite").parquet(_numbered(work, "unmatched", epoch))
        if not none:
            no_accidents = spark.createDataFrame([], T.StructType([*row_schema("siniestros"), T.StructField("landed", T.TimestampType())]))
            merge_batch(spark, store_dir, no_accidents, {c: _of(rows, c) for c in CHILD_TABLES}, version="landed")

    return (joined.writeStream.foreachBatch(body).option("checkpointLocation", f"{work}/checkpoint-waiting")
            .trigger(availableNow=True).start())


def run_delivery(spark: SparkSession, landing: str, store_dir: str, work: str, patience: str = PATIENCE,
                 files_per_trigger: int = 100) -> None:
    """One scheduled run: all that has landed, then the rows that its accidents wake."""
    for query in (lambda: start_intake(spark, landing, store_dir, work, files_per_trigger),
                  lambda: start_waiting(spark, store_dir, work, patience, files_per_trigger)):
        q = query()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
