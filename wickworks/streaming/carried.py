"""All gold indicators on a stream of candles.

Each micro-batch is the batch scan over its rows, gone on from the series'
states before it (``indicators.indicators_from``): the same blocks and folds,
however many rows a batch has of a series.  The states, one row per series, are
a table under the batch's number; so are the results, and a repeated batch
replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.indicators import indicators_from
from wickworks.schema import SERIES_KEY
from wickworks.session import scratch_path
from wickworks.sources.lake import read_table
from wickworks.streaming.versions import forget_before, state_before


def run_gold(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = SERIES_KEY, **periods: int) -> None:
    """Gold rows of a candle stream, for what is available now; see ``read_gold_stream`` and ``read_late_candles``.

    ``stream`` has the keys, event_time and the candle's columns.  Of rows with
    equal key and time in a batch the last to arrive counts.  A row at or before
    its series' last time comes too late for averages that have gone on; it is
    counted, and ``plans.incremental`` recomputes a store with such rows.  A
    missing state of an earlier batch raises.  ``periods`` as in ``indicators``."""
    keys = list(keys)
    states = f"{checkpoint}/series"

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        known = state_before(spark, states, n)
        arrived = batch.withColumn("_at", F.monotonically_increasing_id())
        row = F.struct(*[c for c in batch.columns if c not in (*keys, "event_time")])
        rows = arrived.groupBy(*keys, "event_time").agg(F.max_by(row, "_at").alias("_row"), F.count("*").alias("_n"))
        if known is None:
            rows = rows.withColumn("_late", F.lit(False))
        else:
            rows = rows.join(known.select(*keys, "last_time"), keys, "left").withColumn("_late", F.coalesce(F.col("event_time") <= F.col("last_time"), F.lit(False))).drop("last_time")
        staged = scratch_path(spark, "gold-batch")
        rows.write.parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        rows.where("_late").groupBy(*keys).agg(F.sum("_n").alias("late")).write.mode("overwrite").parquet(f"{path}/late/batch={n}")
        fresh = rows.where("NOT _late").select(*keys, "event_time", "_row.*")
        gold, ends = indicators_from(fresh, None if known is None else known.select(*keys, "state"), keys, "timeframe" if "timeframe" in keys else None, **periods)
        gold.write.mode("overwrite").parquet(f"{path}/rows/batch={n}")
        last = ends.groupBy(*keys).agg(F.max_by(F.struct("last_time", "state"), F.struct("_bucket", "_sub")).alias("s")).select(*keys, "s.*")
        if known is not None:
            last = last.unionByName(known.select(*keys, "last_time", "state").join(last.select(*keys), keys, "left_anti"))
        last.write.mode("overwrite").parquet(f"{states}/batch={n}")
        forget_before(spark, states, n - 1)

    q = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()
    q.awaitTermination()


def read_gold_stream(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``run_gold`` wrote."""
    return read_table(spark, f"{path}/rows").drop("batch")


def read_late_candles(spark: SparkSession, path: str) -> DataFrame:
    """Rows per series that came too late for ``run_gold``."""
    late = read_table(spark, f"{path}/late").drop("batch")
    return late.groupBy(*[c for c in late.columns if c != "late"]).agg(F.sum("late").alias("late"))
