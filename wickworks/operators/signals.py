"""Chart feeds and trading signals computed as columns (no driver loops).

Crosses compare a row with the previous row of its series.  The previous
values come either from the gold computation itself (``indicators(...,
keep_internal=True)`` exposes ``prev_*``) or from ``series_lag`` for a stored
gold table.  ``per_year=True`` reproduces charts drawn one calendar year at a
time: the previous row must lie in the same year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.functions.time import day_number
from wickworks.operators.scan import series_lag
from wickworks.schema import RSI_OVERBOUGHT, RSI_OVERSOLD, SERIES_KEY


def with_prev(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = SERIES_KEY, per_year: bool = False) -> DataFrame:
    """Adds ``prev_<col>`` for the columns that do not have one yet."""
    need = [c for c in cols if f"prev_{c}" not in df.columns]
    if not need and not per_year:
        return df
    extra = ["year"] if per_year else []
    if per_year:
        df = df.drop(*[f"prev_{c}" for c in cols if f"prev_{c}" in df.columns])
        need = list(cols)
        if "year" not in df.columns:
            df = df.withColumn("year", F.year("event_time"))
    return series_lag(df, need, keys, partition_extra=extra)


def cross_flags(fast: str, slow: str) -> tuple[Column, Column]:
    """(up, down): fast crosses above / below slow against the previous row.

    up = fast > slow and prev_fast <= prev_slow; down mirrored; null -> no cross."""
    f, s = F.col(fast), F.col(slow)
    pf, ps = F.col(f"prev_{fast}"), F.col(f"prev_{slow}")
    up = F.coalesce((f > s) & (pf <= ps), F.lit(False))
    down = F.coalesce((f < s) & (pf >= ps), F.lit(False))
    return up, down


def crosses(df: DataFrame, fast: str, slow: str, keys: Sequence[str] = SERIES_KEY, per_year: bool = False) -> DataFrame:
    """Adds ``cross_up`` / ``cross_down`` flags."""
    df = with_prev(df, [fast, slow], keys, per_year)
    up, down = cross_flags(fast, slow)
    return df.withColumn("cross_up", up).withColumn("cross_down", down)


def signal_points(df: DataFrame, value: str = "close") -> DataFrame:
    """Flagged rows only: event_time, direction and the value to mark."""
    return df.where(F.col("cross_up") | F.col("cross_down")).select(
        *[c for c in SERIES_KEY if c in df.columns],
        "event_time",
        F.when(F.col("cross_up"), F.lit("up")).otherwise(F.lit("down")).alias("direction"),
        F.col(value).alias("value"),
    )


def rsi_zone(rsi: Column | str = "rsi_14", low: float = RSI_OVERSOLD, high: float = RSI_OVERBOUGHT) -> Column:
    """'oversold' below ``low``, 'overbought' above ``high`` (strict), else null (D-10)."""
    r = F.col(rsi) if isinstance(rsi, str) else rsi
    return F.when(r < low, F.lit("oversold")).when(r > high, F.lit("overbought"))


def candle_geometry(df: DataFrame) -> DataFrame:
    """Direction, body and wick of each candle (C10): up when close >= open."""
    return df.select(
        *df.columns,
        (F.col("close") >= F.col("open")).alias("is_up"),
        F.least("open", "close").alias("body_low"),
        F.greatest("open", "close").alias("body_high"),
        F.abs(F.col("close") - F.col("open")).alias("body_height"),
        F.col("low").alias("wick_low"),
        F.col("high").alias("wick_high"),
        day_number("event_time").alias("day_num"),
    )


def year_feed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All years in one job, ordered by year then time (S6) — one sort, no per-year loop."""
    if "year" not in df.columns:
        df = df.withColumn("year", F.year("event_time"))
    return df.select("year", *columns).orderBy("year", "event_time")


def first_rows(df: DataFrame, n: int = 30, order: Sequence[str] = ("event_time",)) -> DataFrame:
    """The first ``n`` rows in order (J4): planned as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)
