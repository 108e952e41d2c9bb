"""Bronze -> silver -> gold job.

bronze: landed CSV (text columns) under ``year=/month=`` directories of each
series; silver: typed rows, partitioned by series key, year and month; gold:
silver plus the indicators.  Each layer is written once and read back from
storage, which also cuts the lineage between the layers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.functions.numeric import to_double
from wickworks.operators.indicators import indicators
from wickworks.operators.scan import pass_tables, release
from wickworks.schema import GOLD_COLUMNS, SERIES_KEY, SILVER_COLUMNS
from wickworks.sinks.lake import write_table
from wickworks.sources.lake import read_bronze_csv, read_table


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Typed silver rows; text that does not parse becomes null (ANSI-safe ``try_`` forms)."""
    cols = [F.col(c) for c in SERIES_KEY]
    cols.append(F.try_to_timestamp(F.col("event_time")).alias("event_time"))
    cols += [to_double(c).alias(c) for c in ("open", "high", "low", "close", "volume")]
    cols += [F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")]
    return bronze.select(*cols).select(*SILVER_COLUMNS)


def silver_to_gold(silver: DataFrame, min_timeframe: str | None = None) -> DataFrame:
    return indicators(silver, min_timeframe=min_timeframe).select(*GOLD_COLUMNS)


def run(spark: SparkSession, bronze_path: str, silver_path: str, gold_path: str,
        min_timeframe: str | None = None) -> DataFrame:
    """Run both steps; returns the gold table as read back from ``gold_path``.  The scan's own table is dropped once gold is written."""
    write_table(bronze_to_silver(read_bronze_csv(spark, bronze_path)), silver_path)
    before = pass_tables(spark)
    write_table(silver_to_gold(read_table(spark, silver_path), min_timeframe), gold_path)
    release(spark, keep=before)
    return read_table(spark, gold_path)
