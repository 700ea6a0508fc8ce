"""File sources and sinks: feature-service pages (S1), corridor grid GeoJSON (S2), table
appends (S6), stage directories (S7), CSV reports (S8, S9), fitted parameters (S10), and
unions of landed page sets (U1).

Readers always pass an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.schemas import (BAD_FIELD, ERROR_FIELD, FEATURE_CSV_SCHEMA, GEOMETRY_LAYERS, GRID_PAGE_SCHEMA,
                              RAW_ATTRIBUTES, checked_page_schema)

PAGE_SIZE = 2_000


# --- S1: feature-service pages ----------------------------------------------------------------

def checked_pages(pages: DataFrame) -> DataFrame:
    """Pages read with ``checked_page_schema`` (and a ``file`` column), with the ``reason`` why a
    page is bad (null for a good one; a page with an empty list of features is good).

    ``not json``: the text can't be parsed (cut off, not JSON). ``type clash``: a value doesn't
    fit its attribute's type. ``error page``: the service's error answer. ``no features``:
    JSON of another kind. ``no attributes``: a feature without its attributes.
    """
    bad, features = F.col(BAD_FIELD), F.col("features")
    reason = (F.when(bad.isNotNull() & features.isNull(), "not json").when(bad.isNotNull(), "type clash")
              .when(F.col(ERROR_FIELD).isNotNull(), "error page").when(features.isNull(), "no features")
              .when(F.exists(features, lambda f: f.isNull() | f["attributes"].isNull()), "no attributes"))
    return pages.withColumn("reason", reason)


def read_pages(spark: SparkSession, path: str, layer: str, multiline: bool = False) -> DataFrame:
    """The pages of a folder as they are: (features, error, _bad, file, reason)."""
    pages = (spark.read.schema(checked_page_schema(layer)).option("multiLine", multiline).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", BAD_FIELD).json(path).withColumn("file", F.col("_metadata.file_path")))
    return checked_pages(pages)


def flatten_pages(pages: DataFrame, layer: str) -> DataFrame:
    """The features of pages as flat rows (attribute prefix stripped, geometry as ``x``/``y``)."""
    f = pages.select(F.explode("features").alias("f"))
    cols = [F.col(f"f.attributes.{fld.name}").alias(fld.name) for fld in RAW_ATTRIBUTES[layer]]
    if layer in GEOMETRY_LAYERS:
        cols += [F.col("f.geometry.x").alias("x"), F.col("f.geometry.y").alias("y")]
    return f.select(*cols)


def _good(pages: DataFrame, layer: str, on_bad: str) -> DataFrame:
    """Checked pages without the bad ones (``skip``), or with an error at the first bad one (``fail``)."""
    if on_bad == "skip":
        return pages.where("reason IS NULL")
    said = F.concat(F.lit(f"bad page of {layer} in "), "file", F.lit(": "), "reason")
    return pages.withColumn("features", F.when(F.col("reason").isNull(), F.col("features")).otherwise(F.raise_error(said)))


def bad_pages(spark: SparkSession, path: str, layer: str, multiline: bool = False) -> DataFrame:
    """(layer, file, reason, detail): the bad pages of a folder; ``detail`` is the error
    answer or the page's text."""
    return (read_pages(spark, path, layer, multiline).where("reason IS NOT NULL")
            .select(F.lit(layer).alias("layer"), "file", "reason", F.coalesce(ERROR_FIELD, BAD_FIELD).alias("detail")))


def read_feature_json(spark: SparkSession, path: str, layer: str, multiline: bool = False,
                      on_bad: str = "fail") -> DataFrame:
    """Directory of ``{features: [{attributes: {...}, geometry: {x, y}}]}`` pages ->
    flat rows (attribute prefix stripped, geometry kept as ``x``/``y``).

    ``multiline=True`` reads one pretty-printed document per file (as the service returns
    it); the default reads one page per line (as ``land_pages`` writes them). A bad page
    ends the job with its file and reason; with ``on_bad="skip"`` it is left out, for callers
    that count it (``initial_load``) or list it (``bad_pages``).
    """
    return flatten_pages(_good(read_pages(spark, path, layer, multiline), layer, on_bad), layer)


def as_pages(raw: DataFrame, layer: str, page_size: int = PAGE_SIZE,
             layer_of: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """A raw layer as feature-service pages: (page, features).

    A page holds the features of one OBJECTID range of ``page_size`` ids, the same id-range
    chunking as the bulk extract (S4). OBJECTID is the service's feature id, so each
    ``collect_list`` is bounded by the page size, never by a key of the data, and no
    counting pass is needed. Child rows given as the narrow rows they are made of are turned
    into the layer's own by ``layer_of`` only after the shuffle.
    """
    attrs = [fld.name for fld in RAW_ATTRIBUTES[layer]]
    feat = [F.struct(*[F.col(a) for a in attrs]).alias("attributes")]
    if layer in GEOMETRY_LAYERS:
        feat.append(F.struct(F.col("x"), F.col("y")).alias("geometry"))
    # features without an id are spread by their content, so they are no single page
    content = attrs if layer_of is None else raw.columns
    page = F.coalesce(F.floor(F.col("OBJECTID") / F.lit(page_size)), -1 - F.pmod(F.xxhash64(*content), F.lit(4096)))
    # Rows are shuffled by page before the lists are built: a list never shrinks, so
    # building it map-side would only move the work before the shuffle (into whatever few
    # tasks read the input); pages are bounded, so the shuffle has no hot key.
    rows = raw.withColumn("page", page)
    if layer_of is None:
        rows = rows.select("page", F.struct(*feat).alias("feature")).repartition("page")
    else:
        rows = layer_of(layer, rows.repartition("page")).select("page", F.struct(*feat).alias("feature"))
    return rows.groupBy("page").agg(F.collect_list("feature").alias("features"))


def land_pages(raw: DataFrame, path: str, layer: str, page_size: int = PAGE_SIZE, mode: str = "overwrite",
               layer_of: Callable[[str, DataFrame], DataFrame] | None = None) -> None:
    """Write a raw layer as feature-service pages (one JSON page per line, files compressed:
    page text repeats its attribute names with every feature)."""
    as_pages(raw, layer, page_size, layer_of).select("features").write.mode(mode).option("compression", "gzip").json(path)


# --- S4: pages by id range ---------------------------------------------------------------------

CHUNK_IDS = 30_000


def land_chunks(raw: DataFrame, path: str, layer: str, size: int = CHUNK_IDS, page_size: int = PAGE_SIZE,
                last: int | None = None) -> None:
    """Land a layer's pages with one folder an id range of ``size`` ids (a multiple of
    the page size), as a bulk extract that asks range by range leaves them. Pages are
    distributed by range, so a folder gets few files, and a range that is too large for
    one task is split. With ``last``, that id's range is open-ended: all later ids are in it."""
    if size % page_size:
        raise ValueError(f"{size} ids are no whole number of pages of {page_size}")
    chunk = F.floor(F.col("page") * page_size / F.lit(size)).cast("long")
    if last is not None:
        chunk = F.least(chunk, F.lit(last // size))
    (as_pages(raw, layer, page_size).withColumn("chunk", chunk).hint("rebalance", "chunk")
     .write.mode("overwrite").option("compression", "gzip").partitionBy("chunk").json(path))


def read_id_range(spark: SparkSession, path: str, layer: str, lo: int | None = None, hi: int | None = None,
                  size: int = CHUNK_IDS, on_bad: str = "fail", last: int | None = None) -> DataFrame:
    """The rows of a chunked landing with ``lo <= OBJECTID < hi`` (open where None). Only
    the folders of the ranges asked for are listed and read; rows of the first and last
    range are cut to the bounds."""
    schema = T.StructType([*checked_page_schema(layer).fields, T.StructField("chunk", T.LongType())])
    pages = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_FIELD)
             .json(path).withColumn("file", F.col("_metadata.file_path")))
    open_from = None if last is None else last // size
    if lo is not None:
        first = lo // size
        pages = pages.where(F.col("chunk") >= (first if open_from is None else min(first, open_from)))
    if hi is not None:
        pages = pages.where(F.col("chunk") <= (hi - 1) // size)
    rows = flatten_pages(_good(checked_pages(pages), layer, on_bad), layer)
    if lo is not None:
        rows = rows.where(F.col("OBJECTID") >= lo)
    return rows if hi is None else rows.where(F.col("OBJECTID") < hi)


# --- S2: corridor grid -------------------------------------------------------------------------

def read_corridor_grid(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """GeoJSON feature collections (plain files, indented or not) -> (pos, CIV, MVINOMBRE).

    ``pos`` orders features by file name, then by place in the file, so the first-in-file
    rule (W1) has a total order. A file without features is an error. ``multiline=False``
    reads one collection a line instead of one a file; a file then counts as one collection
    per line, in no stated order of lines.
    """
    pages = (spark.read.schema(GRID_PAGE_SCHEMA).option("multiLine", multiline).json(path)
             .withColumn("file", F.col("_metadata.file_path")))
    # one row a file: bounded by the number of files, and read from the metadata of the parse
    files = pages.groupBy("file").agg(F.max(F.coalesce(F.size("features"), F.lit(0))).alias("most")).orderBy("file").collect()
    empty = [r["file"] for r in files if r["most"] <= 0]
    if empty or not files:
        raise ValueError(f"no features in {empty or path}")
    order = spark.createDataFrame([(r["file"], i) for i, r in enumerate(files)], "file string, file_pos long")
    return (pages.join(order, "file").select("file_pos", F.posexplode("features").alias("i", "f"))
            .select((F.col("file_pos") * F.lit(1 << 32) + F.col("i")).alias("pos"),
                    F.col("f.properties.MVICIV").alias("CIV"),
                    F.col("f.properties.MVINOMBRE").alias("MVINOMBRE")))


def land_grid(grid: DataFrame, path: str, page_size: int = PAGE_SIZE) -> None:
    """Write (pos, CIV, MVINOMBRE) rows as plain GeoJSON files of ``page_size`` consecutive
    positions each, file names in the order of positions."""
    feat = F.struct(F.col("pos"), F.struct(F.lit("Feature").alias("type"), F.struct(
        F.col("CIV").alias("MVICIV"), F.col("MVINOMBRE")).alias("properties")).alias("f"))
    pages = (grid.select(F.floor(F.col("pos") / page_size).cast("long").alias("page"), feat.alias("e"))
             .groupBy("page").agg(F.array_sort(F.collect_list("e")).alias("es"))
             .select(F.lit("FeatureCollection").alias("type"), "page", F.transform("es", lambda e: e["f"]).alias("features")))
    # one collection a file: as many range partitions as pages, one record at most in each file
    n = max(1, grid.select(F.floor(F.col("pos") / page_size)).distinct().count())
    (pages.repartitionByRange(n, "page").sortWithinPartitions("page").drop("page")
     .write.mode("overwrite").option("maxRecordsPerFile", 1).json(path))


# --- U1 -----------------------------------------------------------------------------------------

def union_page_sets(spark: SparkSession, parts: list[tuple[str, str]]) -> DataFrame:
    """Several landed page sets (path, layer) concatenated by column name; columns a
    layer lacks become null."""
    from roadrisk.operators.windows import union_files
    return union_files([read_feature_json(spark, p, layer) for p, layer in parts])


# --- S6, S7: tables and stages ------------------------------------------------------------------

#: Codec of stored tables and stages.
CODEC = "zstd"


def stage_write(df: DataFrame, stage_dir: str, name: str) -> str:
    """Persist an intermediate as Parquet under its own stage directory."""
    path = f"{stage_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return path


def stage_read(spark: SparkSession, stage_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{stage_dir.rstrip('/')}/{name}")


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """One append job per table (the job commit makes it all-or-nothing); callers run
    the integrity checks first (see ``plans.load``)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path, compression=CODEC)


# --- S8, S9: CSV ------------------------------------------------------------------------------

PRIORITY_CSV_SCHEMA = ("MVINOMBRE string, HORARIO string, accidentes long, muertes long, heridos long, "
                       "muertes_vulnerables long, heridos_vulnerables long, vulnerables int, "
                       "label int, Prioridad string")


def write_priorities_csv(scored: DataFrame, path: str) -> None:
    """The scored table in report order, one CSV file with a header and no index.
    The scored table is bounded by the grid x 6 blocks, so a single output file is safe."""
    from roadrisk.operators.windows import priority_sort
    cols = [c for c in scored.columns if c != "rank_pos"]
    (priority_sort(scored.select(*cols)).coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


def read_priorities_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRIORITY_CSV_SCHEMA).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """Reload the feature table with its explicit schema."""
    return spark.read.schema(FEATURE_CSV_SCHEMA).option("header", True).csv(path)


# --- S10: fitted parameters -----------------------------------------------------------------------

def save_params(params: DataFrame, path: str) -> None:
    params.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, spark: SparkSession, path: str) -> None:
    model.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str, cat_types: dict | None = None):
    from roadrisk.operators.kproto import KPrototypesModel
    return KPrototypesModel.from_frame(spark.read.parquet(path), cat_types)
