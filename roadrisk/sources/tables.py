"""Access to the stored tables (S3) and the bulk-extract helpers.

``Tables`` builds the six clean tables and the corridor grid lazily from a directory of
driver Parquet files. Nothing is materialised: every table is a DataFrame plan, so
Catalyst prunes columns and pushes filters into the Parquet scans of each query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadrisk.functions.cleaning import CLEANERS
from roadrisk.sources import adapter


class Tables:
    """Lazy clean tables over one scale-factor directory.

    Plans are built once per instance and reused: DataFrames are immutable, so every query
    that starts from the same table shares its (already analysed) plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._clean: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = adapter.RAW_LAYERS[name](self.spark, self.sf_dir)
        return self._raw[name]

    def clean(self, name: str) -> DataFrame:
        if name not in self._clean:
            self._clean[name] = CLEANERS[name](self.raw(name))
        return self._clean[name]

    def source(self, child: str) -> DataFrame:
        """The rows that a child table is made of: FORMULARIO and few narrow columns."""
        return adapter.CHILD_LAYERS[child][0](self.spark, self.sf_dir)

    @staticmethod
    def layer_of(child: str, source: DataFrame) -> DataFrame:
        """The raw child layer of source rows; partition and page columns that they carry stay."""
        return adapter.CHILD_LAYERS[child][1](source)

    @staticmethod
    def made_of(child: str, source: DataFrame) -> DataFrame:
        """The clean child table of source rows; partition columns that they carry stay."""
        return CLEANERS[child](Tables.layer_of(child, source))

    def __getitem__(self, name: str) -> DataFrame:
        if name == "malla":
            return self.grid
        if name == "malla_raw":
            return self.grid_raw
        return self.clean(name)

    @cached_property
    def siniestros(self) -> DataFrame:
        return self.clean("siniestros")

    @cached_property
    def conheridos(self) -> DataFrame:
        return self.clean("conheridos")

    @cached_property
    def confallecidos(self) -> DataFrame:
        return self.clean("confallecidos")

    @cached_property
    def vehiculos(self) -> DataFrame:
        return self.clean("vehiculos")

    @cached_property
    def actores(self) -> DataFrame:
        return self.clean("actores")

    @cached_property
    def causas(self) -> DataFrame:
        return self.clean("causas")

    @cached_property
    def grid_raw(self) -> DataFrame:
        return adapter.grid_raw(self.spark, self.sf_dir)

    @cached_property
    def grid(self) -> DataFrame:
        """Clean corridor grid: first segment per CIV in file order, named ones only."""
        from roadrisk.operators.windows import dedupe_grid
        from roadrisk.operators.filters import named_corridor
        return named_corridor(dedupe_grid(self.grid_raw))


def read_table(tables: Tables, name: str, columns: list[str] | None = None,
               predicate: Column | None = None) -> DataFrame:
    """S3: one stored table, a column subset and a predicate (pushed to the scan)."""
    df = tables[name]
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def partitioned_extract(df: DataFrame, id_col: str = "OBJECTID", size: int = 30_000,
                        lo: int = 1, hi: int | None = None) -> DataFrame:
    """Tag each row with the id-range chunk of ``size`` ids it belongs to.

    Chunk c covers ``[lo + c*size, lo + (c+1)*size)``; the last chunk (ids >= ``hi``) is
    open-ended, ids below ``lo`` fall in chunk -1. The chunk count follows the data range,
    it is not fixed. The column is only a tag: a partitioned JDBC read splits on the same
    bounds, and no shuffle is added here.
    """
    c = F.floor((F.col(id_col) - F.lit(lo)) / F.lit(size)).cast("long")
    if hi is not None:
        last = (hi - lo) // size
        c = F.least(c, F.lit(last))
    return df.withColumn("chunk", c)


def chunk_summary(df: DataFrame, id_col: str = "OBJECTID") -> DataFrame:
    """Rows and id range per extract chunk (what each bulk request returns)."""
    return (df.groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(id_col).alias("min_id"),
                 F.max(id_col).alias("max_id")))


def extract_by_period(df: DataFrame, years: list[int], last_year: int,
                      last_months: list[int]) -> DataFrame:
    """The yearly slices plus the listed months of the last (partial) year, each row
    tagged with the request it came from (``slice``)."""
    y, m = F.col("ANO_OCURRENCIA_ACC"), F.col("MES_NRO_OCURRENCIA_ACC")
    yearly = y.isin(years)
    monthly = (y == last_year) & m.isin(last_months)
    tag = (F.when(yearly, F.format_string("Y%04d", y))
           .when(monthly, F.format_string("M%04d-%02d", y, m)))
    return df.filter(yearly | monthly).withColumn("slice", tag)


def read_table_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
                    id_col: str | None = None, lo: int | None = None, hi: int | None = None,
                    chunk_rows: int = 30_000) -> DataFrame:
    """S3/S4 against a relational store: one table read over JDBC, split by id range.

    With ``id_col``, Spark issues one range query per partition (``numPartitions`` =
    ceil((hi - lo) / chunk_rows), the last one open-ended), which is the bulk extract's
    chunking. Filters and column selections applied to the result are pushed into the
    queries. (Not exercised in this repository: it needs a database server.)
    """
    if id_col is None:
        return spark.read.jdbc(url, table, properties=properties)
    n = max(1, -(-(hi - lo) // chunk_rows))
    return spark.read.jdbc(url, table, column=id_col, lowerBound=lo, upperBound=hi,
                           numPartitions=n, properties=properties)
