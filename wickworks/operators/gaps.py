"""Gaps as ranges, and what repairs them.

A gap lies between two consecutive candles of a series.  Those inside a block of
the scan are found in the block; for the gaps between blocks only the blocks'
first and last slots are folded, one row per block.  Nothing is expanded to
single slots, so that a year without data is one row, as an hour is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.functions.time import timeframe_ms
from wickworks.operators.quality import slot_index, slot_time
from wickworks.operators.scan import add_blocks, block_window, exclusive_carries, join_on_renamed, materialize, series_lag
from wickworks.schema import MAX_PAGE_LIMIT, SERIES_KEY
from wickworks.sources.klines import fetch_windows


def _slots(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct slots that hold a candle: keys, event_time (the slot's start), ``_slot``."""
    tf = F.col("timeframe")
    known = df.where(timeframe_ms("timeframe").isNotNull() & F.col("event_time").isNotNull())
    slots = known.select(*keys, slot_index(F.col("event_time"), tf).alias("_slot")).distinct()
    return slots.withColumn("event_time", slot_time(F.col("_slot"), tf))


def _between(keys: Sequence[str], before: str, after: str) -> list:
    """Columns of the gap between two slots that hold candles."""
    tf = F.col("timeframe")
    return [*keys, slot_time(F.col(before) + 1, tf).alias("gap_start"), slot_time(F.col(after) - 1, tf).alias("gap_end"),
            (F.col(after) - F.col(before) - 1).alias("n_missing")]


def gap_ranges(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Maximal runs of empty slots between a series' first and last candle: keys, gap_start, gap_end, n_missing.

    gap_start and gap_end are the starts of the first and last empty slot.  As in
    ``missing_candles`` a candle anywhere in a slot fills it, whatever its values;
    a series whose timeframe is no known code is reported by one row of nulls."""
    keys = list(keys)
    blocked, plan = materialize(add_blocks(_slots(df, keys), keys, ["_slot"]), keys)
    before = F.lag("_slot").over(block_window(keys))
    inside = blocked.withColumn("_before", before).where(F.col("_slot") > F.col("_before") + 1).select(*_between(keys, "_before", "_slot"))
    blocks = blocked.groupBy(*keys, "_bucket", "_sub").agg(F.min("_slot").alias("_first"), F.struct(F.max("_slot").alias("last")).alias("_st"))
    carries = exclusive_carries(blocks, keys, "_st", lambda a, b: b, plan)
    border = join_on_renamed(blocks.drop("_st"), carries, [*keys, "_bucket", "_sub"]).withColumn("_before", F.col("_carry.last"))
    border = border.where(F.col("_first") > F.col("_before") + 1).select(*_between(keys, "_before", "_first"))
    unknown = df.where(timeframe_ms("timeframe").isNull()).select(*keys).distinct()
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("gap_start", "timestamp"), ("gap_end", "timestamp"), ("n_missing", "bigint"))]
    return inside.unionByName(border).unionByName(unknown.select(*keys, *nothing))


def candle_runs(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Maximal runs of slots that all hold candles (the islands between the gaps): keys, run_start, run_end, n_candles."""
    keys, tf = list(keys), F.col("timeframe")
    slots = _slots(df, keys).groupBy(*keys).agg(F.min("_slot").alias("_lo"), F.max("_slot").alias("_hi"))
    gaps = gap_ranges(df, keys).where("gap_start IS NOT NULL")
    ends = gaps.select(*keys, (slot_index(F.col("gap_start"), tf) - 1).alias("_end"), (slot_index(F.col("gap_end"), tf) + 1).alias("_next"))
    ends = ends.unionByName(slots.select(*keys, F.col("_hi").alias("_end"), F.lit(None).cast("bigint").alias("_next")))
    runs = series_lag(ends.withColumn("event_time", slot_time(F.col("_end"), tf)), ["_next"], keys)
    runs = join_on_renamed(runs, slots, keys).withColumn("_start", F.coalesce("prev__next", "_lo"))
    return runs.select(*keys, slot_time(F.col("_start"), tf).alias("run_start"), slot_time(F.col("_end"), tf).alias("run_end"),
                       (F.col("_end") - F.col("_start") + 1).alias("n_candles"))


def repair_windows(df: DataFrame, keys: Sequence[str] = SERIES_KEY, limit: int = MAX_PAGE_LIMIT) -> DataFrame:
    """The request windows that fetch what ``df`` lacks (P5 to A3): those of ``fetch_windows`` for each gap."""
    tf = F.col("timeframe")
    gaps = gap_ranges(df, keys).where("gap_start IS NOT NULL")
    end = slot_time(slot_index(F.col("gap_end"), tf) + 1, tf)
    requests = gaps.select("symbol", tf.alias("interval"), F.unix_millis("gap_start").alias("start_ms"), F.unix_millis(end).alias("end_ms"))
    return fetch_windows(requests, limit)
