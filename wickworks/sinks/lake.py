"""Lake sinks.

``write_lake`` is the partitioned OHLCV store writer: rows are clustered by
their partition directory with one hash exchange, sorted by event_time inside
each task (tight row-group min/max), capped per file, and written with dynamic
partition overwrite so that only the touched months are replaced.  Nothing is
coalesced to one task; AQE sizes the write tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.functions.time import to_utc_timestamp_col, unreadable_time
from wickworks.operators.dedup import dedup_last
from wickworks.schema import DEFAULT_MAX_ROWS_PER_FILE, OHLCV_COLUMNS, SERIES_KEY


def with_partition_columns(df: DataFrame, col: str = "event_time") -> DataFrame:
    """year and zero-padded month of the UTC event time (month text ``01`` reads back as 1)."""
    return df.withColumn("year", F.year(col)).withColumn("month", F.lpad(F.month(col).cast("string"), 2, "0"))


def write_lake(
    df: DataFrame,
    root: str,
    mode: str = "append",
    max_rows_per_file: int = DEFAULT_MAX_ROWS_PER_FILE,
    partitions: tuple[str, ...] = ("source", "symbol", "timeframe", "year", "month"),
    keep_last: bool = True,
    bad_times: str | None = None,
) -> None:
    """Write contract rows to ``root/source=/symbol=/timeframe=/year=/month=``.

    ``mode="overwrite"`` replaces only the partitions present in ``df``
    (dynamic partition overwrite); ``append`` adds files next to the existing ones.
    ``keep_last`` leaves one row per key (the last by ingestion_time and ``seq``,
    if there is one); False for rows that have one per key already.  Times are
    brought to UTC (C3, C4).  A row with text that is no time ends the write with
    an error; with the folder ``bad_times`` such rows are appended there as they
    came (Parquet), and the others are written."""
    times = ("event_time", "ingestion_time")
    bad = unreadable_time(df, *times)
    if bad_times is not None:
        df.where(bad).write.mode("append").parquet(bad_times)
        df = df.where(~bad)
    elif any(df.schema[c].dataType.typeName() == "string" for c in times):
        what = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in times])
        error = F.raise_error(F.concat(F.lit("no time that can be read: "), what)).cast("boolean")
        df = df.where(F.when(bad, error).otherwise(F.lit(True)))
    df = df.withColumns({c: to_utc_timestamp_col(df, c) for c in times})
    if keep_last:
        df = dedup_last(df)
    out = with_partition_columns(df.select(*OHLCV_COLUMNS))
    (
        out.repartition(*partitions)
        .sortWithinPartitions(*partitions, "event_time")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(root)
    )


def write_csv_partitioned(df: DataFrame, root: str, keys: tuple[str, ...] = tuple(SERIES_KEY)) -> None:
    """Month files of CSV with header, replacing only the months written."""
    out = with_partition_columns(df)
    parts = (*keys, "year", "month")
    (
        out.repartition(*parts)
        .sortWithinPartitions(*parts, "event_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
        .partitionBy(*parts)
        .csv(root)
    )


def write_table(df: DataFrame, path: str, partitions: tuple[str, ...] = (*SERIES_KEY, "year", "month")) -> None:
    """Silver/gold sink: full overwrite, partitioned by series key and year/month.

    The reference funnelled gold through ``coalesce(1)``; here the rows are hash
    clustered by the output partition instead, so every directory is written by
    one task and the job keeps its parallelism."""
    (
        df.repartition(*partitions)
        .sortWithinPartitions(*partitions, "event_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, timestamps as ISO-8601."""
    return df.select(
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"timestampFormat": JSON_TS_FORMAT}).alias("json")
    )
