"""Structured Streaming: real-time candles, deduplication and indicators.

* ``stream_candles``: ticks -> tumbling-window candles with a watermark, append
  mode (a candle is emitted once the watermark passes its end).
* ``stream_dedup``: the contract key deduplicated within the watermark (a stream
  keeps the first arrival; the batch store keeps the last).
* ``stream_keep_last``: the newest version of each contract key, once the watermark
  has passed it, as the batch store keeps it.
* ``run_ema``: EMA per series, each micro-batch the batch scan carried on from the
  last value per series (``streaming.carried`` has all gold indicators).

Sinks are file sinks under the shared checkpoint folder, never the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.indicators import Ema, ema
from wickworks.operators.dedup import dedup_last
from wickworks.schema import OHLCV_COLUMNS, SERIES_KEY
from wickworks.session import scratch_path
from wickworks.streaming.versions import forget_before, state_before


def stream_candles(ticks: DataFrame, timeframe: str = "1 hour", tf_code: str = "1h", delay: str = "1 hour") -> DataFrame:
    """Ticks (source, symbol, ts, price, size, seq) -> candles in append mode."""
    order = F.struct("ts", "seq", "price")
    out = (
        ticks.withWatermark("ts", delay)
        .groupBy("source", "symbol", F.window("ts", timeframe).alias("w"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("size").alias("volume"),
            F.max("ts").alias("ingestion_time"),
        )
    )
    return out.select(
        F.col("w.start").alias("event_time"), "symbol", F.lit(tf_code).alias("timeframe"),
        "open", "high", "low", "close", "volume", "source", "ingestion_time",
    ).select(*OHLCV_COLUMNS)


def stream_dedup(rows: DataFrame, keys: Sequence[str], time_col: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """First arrival per key within the watermark."""
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_keep_last(rows: DataFrame, keys: Sequence[str] = (*SERIES_KEY, "event_time"), order: Sequence[str] = ("ingestion_time", "seq"),
                     time_col: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """The newest version per key (F10 on a stream), in append mode: ``dedup_last`` with a watermark.

    ``time_col`` must be among ``keys``.  The state holds one version per open
    key; when the watermark passes a key's time its last version is emitted, and
    its state goes.  A version that comes after that is late and is dropped by
    Spark's late-row filter, which counts it (``numRowsDroppedByWatermark``)."""
    if time_col not in keys:
        raise ValueError(f"{time_col} must be a key: a version is final when the watermark passes it")
    return dedup_last(rows.withWatermark(time_col, delay), keys, order)


def run_ema(stream: DataFrame, path: str, checkpoint: str, alpha: float, name: str = "ema", source: str = "close",
            keys: Sequence[str] = SERIES_KEY) -> None:
    """EMA per series over a candle stream, for what is available now; see ``read_ema`` and ``read_late``.

    Each micro-batch is the batch EMA (a blocked scan, however long a series) over
    its rows and, ahead of them, one row per series that holds the last value: the
    recurrence goes on from there, nulls included.  Of rows with equal times the
    last to arrive counts.  A row at or before a series' last time comes too late
    for a recurrence; it is counted.  Results, counts and series states are written
    under the batch's number, so a repeated batch replaces itself."""
    keys = list(keys)
    value, states = F.col(source).cast("double").alias(source), f"{checkpoint}/series"

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        ddl = ", ".join([f"{k} string" for k in keys] + ["last double", "last_time timestamp"])
        known = state_before(spark, states, n)
        known = spark.createDataFrame([], ddl) if known is None else known.select(*keys, "last", "last_time")
        arrived = batch.select(*keys, "event_time", value).withColumn("_at", F.monotonically_increasing_id())
        rows = arrived.groupBy(*keys, "event_time").agg(F.max_by(source, "_at").alias(source), F.count("*").alias("n"))
        rows = rows.join(known, keys, "left").withColumn("late", F.coalesce(F.col("event_time") <= F.col("last_time"), F.lit(False)))
        staged = scratch_path(spark, "ema-batch")
        rows.write.parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        rows.where("late").groupBy(*keys).agg(F.sum("n").alias("late")).write.mode("overwrite").parquet(f"{path}/late/batch={n}")
        fresh = rows.where("NOT late").select(*keys, "event_time", source, F.lit(False).alias("_old"))
        old = known.select(*keys, F.col("last_time").alias("event_time"), F.col("last").alias(source), F.lit(True).alias("_old"))
        old = old.join(fresh.select(*keys).distinct(), keys, "left_semi")
        values = ema(fresh.unionByName(old), [Ema(name, source, alpha)], keys, "timeframe" if "timeframe" in keys else None)
        out = f"{path}/rows/batch={n}"
        values.where("NOT _old").select(*keys, "event_time", source, name).write.mode("overwrite").parquet(out)
        done = spark.read.schema(values.select(*keys, "event_time", source, name).schema).parquet(out)
        last = done.groupBy(*keys).agg(F.max_by(name, "event_time").alias("last"), F.max("event_time").alias("last_time"))
        last.unionByName(known.join(last, keys, "left_anti")).write.mode("overwrite").parquet(f"{states}/batch={n}")
        forget_before(spark, states, n - 1)

    q = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()
    q.awaitTermination()


def read_ema(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``run_ema`` wrote."""
    return spark.read.parquet(f"{path}/rows").drop("batch")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Rows per series that came too late for ``run_ema``."""
    late = spark.read.parquet(f"{path}/late").drop("batch")
    return late.groupBy(*[c for c in late.columns if c != "late"]).agg(F.sum("late").alias("late"))


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available now into a Parquet sink, then stop."""
    q = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
