"""Candles of a tick stream that late ticks still revise.

A micro-batch folds its ticks to partial candles: first and last with their
times, highest, lowest, sum.  Partials merge in any order, so a candle is the
merge of its partials of all batches, and no tick is too late or needs an open
window in memory.  Each batch writes its own partials under its number, and a
repeated batch replaces its own: nothing counts twice.  Every few batches what
is there is compacted into one table, which later readers and compactions start
from; its old parts are deleted a compaction later.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.candles import slot_start
from wickworks.schema import OHLCV_COLUMNS
from wickworks.sources.lake import exists, read_table


def partial_candles(ticks: DataFrame, timeframe: str, key: Sequence[str] = ("source", "symbol"), ts: str = "ts", price: str = "price",
                    size: str = "size", tie: str = "seq") -> DataFrame:
    """Mergeable candles: key, event_time, first and last (time, tie-break, price), high, low, volume, ticks."""
    tick = F.struct(F.col(ts).alias("ts"), F.col(tie).alias("seq"), F.col(price).alias("price"))
    return ticks.withColumn("event_time", slot_start(ts, timeframe)).groupBy(*key, "event_time").agg(
        F.min(tick).alias("first"), F.max(tick).alias("last"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.sum(size).alias("volume"), F.count("*").alias("ticks"),
    )


def merged(partials: DataFrame, key: Sequence[str] = ("source", "symbol")) -> DataFrame:
    """One partial per candle."""
    return partials.groupBy(*key, "event_time").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("ticks").alias("ticks"),
    )


def candles(partials: DataFrame, tf_code: str) -> DataFrame:
    """Merged partials as contract rows; ingestion_time is the time of the last tick."""
    return partials.select(
        "event_time", "symbol", F.lit(tf_code).alias("timeframe"), F.col("first.price").alias("open"), "high", "low",
        F.col("last.price").alias("close"), "volume", "source", F.col("last.ts").alias("ingestion_time"),
    ).select(*OHLCV_COLUMNS)


def run_candles(stream: DataFrame, path: str, checkpoint: str, timeframe: str = "1h", compact_every: int = 20) -> None:
    """Fold the ticks (source, symbol, ts, price, size, seq) that are available now into the candle table at ``path``."""

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        partial_candles(batch, timeframe).write.mode("overwrite").parquet(f"{path}/parts/batch={n}")
        if n % compact_every == compact_every - 1:
            _compact(spark, path, n)

    q = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _numbers(spark: SparkSession, folder: str, complete: bool = False) -> list[int]:
    """Numbers of the batches in ``folder``; with ``complete`` of those whose write has ended."""
    if not exists(spark, folder):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    found = sorted(int(m[1]) for m in (re.fullmatch(r"batch=(\d+)", x) for x in names) if m)
    return [n for n in found if not complete or exists(spark, f"{folder}/batch={n}/_SUCCESS")]


def _current(spark: SparkSession, path: str) -> DataFrame:
    """All partials: the last complete compaction and the batches after it."""
    base = _numbers(spark, f"{path}/base", complete=True)[-1:]
    parts = [f"{path}/parts/batch={n}" for n in _numbers(spark, f"{path}/parts", complete=True) if not base or n > base[0]]
    frames = [read_table(spark, p) for p in [*[f"{path}/base/batch={n}" for n in base], *parts]]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _compact(spark: SparkSession, path: str, n: int) -> None:
    """Merge all partials up to batch ``n`` into base ``n``; delete what the base before last and the last hold already."""
    done = [b for b in _numbers(spark, f"{path}/base", complete=True) if b < n]
    base = done[-1:]
    parts = [p for p in _numbers(spark, f"{path}/parts") if p <= n and (not base or p > base[0])]
    frames = [read_table(spark, f"{path}/base/batch={b}") for b in base] + [read_table(spark, f"{path}/parts/batch={p}") for p in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    merged(out).write.mode("overwrite").parquet(f"{path}/base/batch={n}")
    old = [f"{path}/base/batch={b}" for b in done[:-1]] + [f"{path}/parts/batch={p}" for p in _numbers(spark, f"{path}/parts") if base and p <= base[0]]
    for folder in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_candles(spark: SparkSession, path: str, tf_code: str = "1h") -> DataFrame:
    """Every candle with all ticks so far, those of windows that are still open included."""
    return candles(merged(_current(spark, path)), tf_code)
