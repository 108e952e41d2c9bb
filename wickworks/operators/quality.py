"""Data-quality checks and repairs against the expected candle grid.

The grid of a series is every timeframe slot between its first and last
candle.  It is generated in two steps — chunks of ``CHUNK`` slots first,
re-distributed by a hash exchange, then the slots of each chunk — so a long or
hot series is expanded by many tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.functions.time import candles_per_day, timeframe_ms
from wickworks.operators.scan import join_on_renamed, series_ffill
from wickworks.schema import OHLCV_COLUMNS, SERIES_KEY
from wickworks.session import scratch_path

CHUNK = 4096


# Monday 1970-01-05: weekly slots start on Mondays, as weekly candles do.
_WEEK_ORIGIN = "1970-01-05"


def slot_index(ts: Column, tf: Column) -> Column:
    """Slot number of ``ts`` for the timeframe code ``tf``: calendar months for ``1M``,
    Monday weeks for ``1w``, epoch-aligned fixed lengths otherwise."""
    months = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
    weeks = F.floor(F.datediff(F.to_date(ts), F.to_date(F.lit(_WEEK_ORIGIN))) / 7)
    fixed = F.floor(F.unix_millis(ts) / timeframe_ms(tf))
    return (F.when(tf == "1M", months).when(tf == "1w", weeks).otherwise(fixed)).cast("bigint")


def slot_time(slot: Column, tf: Column) -> Column:
    """Start time of slot number ``slot`` (inverse of ``slot_index``)."""
    month_start = F.add_months(F.to_date(F.lit("1970-01-01")), slot.cast("int")).cast("timestamp")
    week_start = F.date_add(F.to_date(F.lit(_WEEK_ORIGIN)), (slot * 7).cast("int")).cast("timestamp")
    fixed = F.timestamp_millis(slot * timeframe_ms(tf))
    return F.when(tf == "1M", month_start).when(tf == "1w", week_start).otherwise(fixed)


def expected_grid(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Every slot between first and last candle of each series: keys + event_time."""
    keys = list(keys)
    tf = F.col("timeframe")
    rng = (
        df.where(timeframe_ms("timeframe").isNotNull())
        .withColumn("_slot", slot_index(F.col("event_time"), tf))
        .groupBy(*keys)
        .agg(F.min("_slot").alias("_slo"), F.max("_slot").alias("_shi"))
    )
    chunks = rng.withColumn(
        "_chunk", F.explode(F.sequence(F.floor(F.col("_slo") / CHUNK).cast("bigint"), F.floor(F.col("_shi") / CHUNK).cast("bigint")))
    ).repartition(*keys, "_chunk")
    slots = chunks.withColumn(
        "_slot",
        F.explode(
            F.sequence(
                F.greatest(F.col("_chunk") * CHUNK, F.col("_slo")),
                F.least(F.col("_chunk") * CHUNK + (CHUNK - 1), F.col("_shi")),
            )
        ),
    )
    return slots.select(*keys, slot_time(F.col("_slot"), tf).alias("event_time"), "_slot")


def missing_candles(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Grid slots with no candle (P5): anti join on (series key, slot).

    A candle anywhere in a slot, off the grid's times or without a close, fills
    the slot.  A series whose timeframe is no known code has no grid: it is
    reported by one row with null event_time."""
    known = timeframe_ms("timeframe").isNotNull()
    present = df.where(known).select(*keys, slot_index(F.col("event_time"), F.col("timeframe")).alias("_slot"))
    missing = join_on_renamed(expected_grid(df, keys), present, list(keys) + ["_slot"], "left_anti").drop("_slot")
    unknown = df.where(~known).select(*keys).distinct().withColumn("event_time", F.lit(None).cast("timestamp"))
    return missing.unionByName(unknown)


def gap_fill(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Complete series (P6): a missing slot gets open=high=low=close = the previous
    candle's close, volume 0 and ``is_filled`` true.

    Every candle of ``df`` comes back as it is: off-grid ones, those without a
    close, and those of series whose timeframe has no grid.  ``df`` is written once,
    as the grid, the slots held and the fill each read it."""
    path = scratch_path(df.sparkSession, "gap-fill")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    missing = missing_candles(df, keys).where("event_time IS NOT NULL").withColumn("is_filled", F.lit(True))
    full = df.withColumn("is_filled", F.lit(False)).unionByName(missing, allowMissingColumns=True)
    full = series_ffill(full, ["close"], keys)
    fill = F.col("last_close")
    out = full.select(
        "event_time",
        *[c for c in keys],
        *[F.when(F.col("is_filled"), fill).otherwise(F.col(c)).alias(c) for c in ("open", "high", "low", "close")],
        F.when(F.col("is_filled"), F.lit(0.0)).otherwise(F.col("volume")).alias("volume"),
        "ingestion_time",
        "is_filled",
    )
    return out.select(*OHLCV_COLUMNS, "is_filled")


def completeness(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Per series: candles present, expected slots on the grid, the day-based
    estimate (days + 1) x candles-per-day (F11), and present / grid ratio."""
    keys = list(keys)
    slot = slot_index(F.col("event_time"), F.col("timeframe"))
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("present"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.min(slot).alias("_lo"),
        F.max(slot).alias("_hi"),
    )
    out = out.withColumn("expected", (F.col("_hi") - F.col("_lo") + 1).cast("bigint"))
    out = out.withColumn(
        "estimated",
        ((F.datediff(F.to_date("last_event"), F.to_date("first_event")) + 1) * candles_per_day("timeframe")).cast("bigint"),
    )
    return out.select(
        *keys, "first_event", "last_event", "present", "expected", "estimated",
        (F.col("present") / F.col("expected")).alias("ratio"),
    )
