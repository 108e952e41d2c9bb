"""Slot bitmaps: which candles a series has, one bit per slot.

The candles of a series and month set bits in bitmaps of 32,768 slots (one for
an hourly month, two for a minute month), built by a partial aggregation: what
is shuffled is 4 KB per month and task instead of its rows.  Bitmaps of later
loads are merged by a bitwise or, so that a store's completeness is kept up to
date without reading its candles again.  No grid of expected slots is expanded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.functions.time import candles_per_day, timeframe_ms
from wickworks.operators.quality import slot_index, slot_time
from wickworks.operators.scan import join_on_renamed
from wickworks.schema import SERIES_KEY

BITS = 32_768


def _month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1)).cast("timestamp")


def _month_slots(start: Column, tf: Column) -> tuple[Column, Column]:
    """First slot that begins in the month of ``start``, and the first one after it."""
    nxt = F.add_months(start.cast("date"), 1).cast("timestamp")
    first = lambda t: slot_index(t, tf) + F.when(slot_time(slot_index(t, tf), tf) < t, 1).otherwise(0)
    return first(start), first(nxt)


def slot_bitmaps(df: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """(keys, year, month, part, bits, rows, first_event, last_event) of candles with a time and a known timeframe.

    A slot belongs to the month it begins in; ``part`` numbers the bitmaps of a
    month.  ``rows`` counts candles, those of one slot each by itself."""
    tf = F.col("timeframe")
    rows = df.where(timeframe_ms("timeframe").isNotNull() & F.col("event_time").isNotNull())
    rows = rows.select(*keys, "event_time", slot_index(F.col("event_time"), tf).alias("_slot")).withColumn("_at", slot_time(F.col("_slot"), tf))
    rows = rows.withColumns({"year": F.year("_at"), "month": F.month("_at")})
    place = F.col("_slot") - _month_slots(_month_start(F.col("year"), F.col("month")), tf)[0]
    rows = rows.withColumn("_place", place).withColumn("part", F.floor(F.col("_place") / BITS).cast("int"))
    return rows.groupBy(*keys, "year", "month", "part").agg(
        F.bitmap_construct_agg(F.pmod("_place", F.lit(BITS))).alias("bits"), F.count("*").alias("rows"),
        F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event"),
    )


def merge_bitmaps(*bitmaps: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """The bitmaps of several loads as one; a slot that several loads hold counts once (its ``rows`` add up)."""
    both = bitmaps[0]
    for b in bitmaps[1:]:
        both = both.unionByName(b)
    return both.groupBy(*keys, "year", "month", "part").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("rows").alias("rows"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")
    )


def completeness_of(bitmaps: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """``quality.completeness`` from bitmaps, with ``missing``: expected slots without a candle, exact with repeated ones too."""
    keys, tf = list(keys), F.col("timeframe")
    out = bitmaps.groupBy(*keys).agg(
        F.sum("rows").alias("present"), F.sum(F.bitmap_count("bits")).alias("_slots"),
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
    )
    expected = slot_index(F.col("last_event"), tf) - slot_index(F.col("first_event"), tf) + 1
    days = F.datediff(F.to_date("last_event"), F.to_date("first_event")) + 1
    out = out.withColumns({"expected": expected, "estimated": (days * candles_per_day("timeframe")).cast("bigint")})
    return out.select(*keys, "first_event", "last_event", "present", "expected", "estimated", (F.col("present") / F.col("expected")).alias("ratio"),
                      (F.col("expected") - F.col("_slots")).alias("missing"))


def months_of(bitmaps: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """(keys, year, month, n_slots, n_missing): per month the slots from a series' first to its last candle, and those without one.

    Months without any candle are listed too: of each series the numbers of its
    months, not of its slots, are expanded."""
    keys, tf = list(keys), F.col("timeframe")
    number = lambda t: F.year(t) * 12 + F.month(t) - 1
    span = bitmaps.groupBy(*keys).agg(F.min(slot_index(F.col("first_event"), tf)).alias("_lo"), F.max(slot_index(F.col("last_event"), tf)).alias("_hi"))
    at = lambda c: number(slot_time(F.col(c), tf))
    months = span.withColumn("_no", F.explode(F.sequence(at("_lo"), at("_hi"))))
    months = months.withColumns({"year": F.floor(F.col("_no") / 12).cast("int"), "month": (F.col("_no") % 12 + 1).cast("int")})
    begin, after = _month_slots(_month_start(F.col("year"), F.col("month")), tf)
    months = months.withColumn("n_slots", F.least(F.col("_hi") + 1, after) - F.greatest(F.col("_lo"), begin))
    held = bitmaps.groupBy(*keys, "year", "month").agg(F.sum(F.bitmap_count("bits")).alias("_held"))
    both = join_on_renamed(months, held, [*keys, "year", "month"], "left")
    return both.select(*keys, "year", "month", "n_slots", (F.col("n_slots") - F.coalesce("_held", F.lit(0))).alias("n_missing"))
