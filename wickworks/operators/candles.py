"""Candle construction and resampling (multi-timeframe aggregation).

Both are one hash aggregation on (series key, time slot) with partial
(map-side) aggregation, so a hot symbol is pre-reduced before the shuffle.
open/close are the price at the earliest/latest (time, tie-break) point of the
slot via ``min_by``/``max_by`` over a struct, which makes the choice
deterministic when timestamps tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.schema import OHLCV_COLUMNS, TIMEFRAME_MS


def slot_start(ts: Column | str, timeframe: str) -> Column:
    """Start of the ``timeframe`` slot holding ``ts`` (UTC).

    Minute/hour/day codes are epoch-aligned; ``1w`` starts on Monday and ``1M`` on
    the first of the calendar month (the 30-day constant is only a paging step)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    ts = ts.cast("timestamp")
    if timeframe == "1w":
        return F.date_trunc("week", ts)
    if timeframe == "1M":
        return F.date_trunc("month", ts)
    if timeframe not in TIMEFRAME_MS:
        raise ValueError(f"Invalid interval: {timeframe}")
    us = TIMEFRAME_MS[timeframe] * 1000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(us)))


def ticks_to_candles(
    ticks: DataFrame,
    timeframe: str,
    key: Sequence[str] = ("source", "symbol"),
    ts: str = "ts",
    price: str = "price",
    size: str = "size",
    tie: str | None = "seq",
) -> DataFrame:
    """Trades/ticks -> OHLCV candles of ``timeframe`` (contract column order).

    ``ingestion_time`` is the time of the slot's last tick."""
    # (time, tie-break, price): a total order even when tie-break values repeat
    order = F.struct(F.col(ts), F.col(tie), F.col(price)) if tie else F.struct(F.col(ts), F.col(price))
    out = (
        ticks.withColumn("event_time", slot_start(ts, timeframe))
        .groupBy(*key, "event_time")
        .agg(
            F.min_by(F.col(price), order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(F.col(price), order).alias("close"),
            F.sum(size).alias("volume"),
            F.max(F.col(ts)).cast("timestamp").alias("ingestion_time"),
        )
        .withColumn("timeframe", F.lit(timeframe))
    )
    return out.select(*OHLCV_COLUMNS)


def _check_multiple(source: str, target: str) -> None:
    """Candles of ``source`` must tile slots of ``target`` exactly."""
    calendar = {"1w": "1d", "1M": "1d"}  # a week or month is made of days
    for tf in (source, target):
        if tf not in TIMEFRAME_MS:
            raise ValueError(f"Invalid interval: {tf}")
    unit = TIMEFRAME_MS[calendar.get(target, target)]
    if source != target and (source in calendar or unit % TIMEFRAME_MS[source]):
        raise ValueError(f"{target} candles can't be made of {source} candles")


def resample(candles: DataFrame, timeframe: str | Sequence[str], source_timeframe: str = "1h",
             key: Sequence[str] = ("source", "symbol")) -> DataFrame:
    """Candles -> coarser candles: open first, high max, low min, close last, volume sum.

    Only the candles of ``source_timeframe`` are used, so that trades held in
    several timeframes count once; ``timeframe`` (one, or several in one pass) must
    be multiples of it."""
    targets = [timeframe] if isinstance(timeframe, str) else list(timeframe)
    for tf in targets:
        _check_multiple(source_timeframe, tf)
    rows = candles.where(F.col("timeframe") == source_timeframe).drop("timeframe")
    if len(targets) == 1:
        return _folded(rows.withColumn("_slot", slot_start("event_time", targets[0])), F.lit(targets[0]), F.col("_slot"), key)
    slots = F.array(*[F.struct(F.lit(tf).alias("timeframe"), slot_start("event_time", tf).alias("start")) for tf in targets])
    return _folded(rows.withColumn("_slot", F.explode(slots)), F.col("_slot.timeframe"), F.col("_slot.start"), key)


def _folded(rows: DataFrame, timeframe: Column, start: Column, key: Sequence[str]) -> DataFrame:
    """One candle per key and ``_slot``."""
    out = rows.groupBy(*key, "_slot").agg(
        F.min_by("open", "event_time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "event_time").alias("close"),
        F.sum("volume").alias("volume"),
        F.max("ingestion_time").alias("ingestion_time"),
    )
    return out.withColumns({"event_time": start, "timeframe": timeframe}).select(*OHLCV_COLUMNS)


def cascade(candles: DataFrame, timeframes: Sequence[str], source_timeframe: str = "1m", key: Sequence[str] = ("source", "symbol")) -> DataFrame:
    """Candles of several timeframes, each made of the next finer ones.

    Every timeframe must be a multiple of the one before it, the first of
    ``source_timeframe``.  The source is read once and reduced once: a level's
    input is the level below, whose shuffle is reused (a chain of hash
    aggregations, no row is copied per target)."""
    out, finer, of = None, candles, source_timeframe
    for tf in timeframes:
        finer = resample(finer, tf, of, key)
        out, of = finer if out is None else out.unionByName(finer), tf
    if out is None:
        raise ValueError("no timeframe to make")
    return out


def with_vwap(df: DataFrame, quote_volume: str = "quote_volume", volume: str = "volume") -> DataFrame:
    """Volume-weighted average price = quote volume / volume, null when volume is 0."""
    return df.withColumn("vwap", F.try_divide(F.col(quote_volume), F.col(volume)))
