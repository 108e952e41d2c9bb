"""Lake scans: the partitioned OHLCV store, bronze CSV, silver and gold tables.

The store layout is ``<root>/source=/symbol=/timeframe=/year=YYYY/month=MM/part-*.parquet``;
every read goes through Spark's partition discovery so that series, year and
month predicates become PartitionFilters and only the needed directories are
listed and read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickworks.schema import LAKE_PARTITIONS, OHLCV_COLUMNS, OHLCV_SCHEMA, SERIES_KEY

LAKE_SCHEMA = T.StructType(
    [f for f in OHLCV_SCHEMA.fields if f.name not in LAKE_PARTITIONS]
    + [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# Bronze CSV: data columns as text in file order, then the partition directories.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("event_time", "open", "high", "low", "close", "volume", "ingestion_time")]
    + [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there something at ``path``, in the file system that Spark reads it from?"""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """The whole store with partition columns; empty typed frame when nothing is there."""
    if not exists(spark, root):
        return spark.createDataFrame([], LAKE_SCHEMA)
    return (
        spark.read.schema(LAKE_SCHEMA)
        .option("basePath", root)
        .option("recursiveFileLookup", "false")
        .parquet(root)
    )


def read_partition(
    spark: SparkSession,
    root: str,
    source: str,
    symbol: str,
    timeframe: str,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Rows of one series, optionally one year or one year/month, in contract order
    sorted by event_time (A4).  A month without a year is ignored, as before."""
    df = read_lake(spark, root).where(
        (F.col("source") == source) & (F.col("symbol") == symbol) & (F.col("timeframe") == timeframe)
    )
    if year is not None:
        df = df.where(F.col("year") == year)
        if month is not None:
            df = df.where(F.col("month") == month)
    return df.select(*OHLCV_COLUMNS).orderBy("event_time")


def lake_files(df: DataFrame) -> DataFrame:
    """Distinct data files behind a lake scan, sorted."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).distinct().orderBy("file_path")


def lake_info(df: DataFrame) -> DataFrame:
    """Rows, first and last event_time, and file count per series (F3); reads only
    event_time and the file name column."""
    return df.groupBy("source", "symbol", "timeframe").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count_distinct(F.col("_metadata.file_path")).cast("bigint").alias("file_count"),
    )


def read_bronze_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bronze CSV with header and an explicit all-text schema (no inference pass);
    ``year=``/``month=`` directories are discovered as partition columns."""
    return spark.read.schema(BRONZE_SCHEMA).option("header", True).option("basePath", path).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Silver or gold Parquet table (A6, A7); the series key stays text, whatever a folder's name looks like."""
    found = spark.read.parquet(path)
    text = [T.StructField(f.name, T.StringType()) if f.name in SERIES_KEY else f for f in found.schema.fields]
    return spark.read.schema(T.StructType(text)).parquet(path)
