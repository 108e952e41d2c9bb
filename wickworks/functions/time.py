"""Time helpers (session time zone is UTC throughout)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickworks.schema import CANDLES_PER_DAY, DEFAULT_CANDLES_PER_DAY, TIMEFRAME_MS


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def timeframe_ms(tf: Column | str) -> Column:
    """Interval code -> milliseconds (null for unknown codes; ``1m`` and ``1M`` differ)."""
    tf = F.col(tf) if isinstance(tf, str) else tf
    return _literal_map(TIMEFRAME_MS)[tf].cast("bigint")


def candles_per_day(tf: Column | str) -> Column:
    """Interval code -> expected candles per day, 24 for codes without an entry."""
    tf = F.col(tf) if isinstance(tf, str) else tf
    return F.coalesce(_literal_map(CANDLES_PER_DAY)[tf], F.lit(DEFAULT_CANDLES_PER_DAY)).cast("bigint")


def from_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds -> UTC timestamp."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(ms.cast("bigint"))


def to_epoch_ms(ts: Column | str) -> Column:
    """Timestamp -> epoch milliseconds (truncating sub-millisecond digits)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))


def to_ntz(ts: Column | str) -> Column:
    """UTC timestamp -> timestamp without zone (wall clock in UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp_ntz")


def end_of_day_exclusive(d: Column | str) -> Column:
    """Start of the day after ``d``: an inclusive end date becomes a half-open bound."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_add(d.cast("date"), 1).cast("timestamp")


def parse_date_strict(s: Column | str) -> Column:
    """Strict ``yyyy-MM-dd`` text -> date (ANSI mode raises on bad text)."""
    s = F.col(s) if isinstance(s, str) else s
    return F.to_date(s, "yyyy-MM-dd")


def zero_pad_month(m: Column | str) -> Column:
    m = F.col(m) if isinstance(m, str) else m
    return F.lpad(m.cast("string"), 2, "0")


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text of a UTC timestamp, e.g. ``2024-01-01T00:00:00+00:00``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def day_number(ts: Column | str) -> Column:
    """Fractional days since 1970-01-01 (the numeric date axis of chart feeds)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp")) / F.lit(86_400_000_000.0)


def to_utc_timestamp_col(df, name: str) -> Column:
    """The column ``name`` of ``df`` as a UTC timestamp (C3, C4): zoned text is converted
    from its offset, text or timestamps without a zone are taken as UTC wall clock,
    numbers are epoch milliseconds.  Text that can't be read becomes null: see
    ``unreadable_time``."""
    from pyspark.sql import types as T

    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.StringType):
        return F.try_to_timestamp(c)
    if isinstance(dt, T.TimestampNTZType):
        return c.cast("timestamp")
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(c)
    if isinstance(dt, T.DateType):
        return c.cast("timestamp")
    return c


def unreadable_time(df, *names: str) -> Column:
    """Is there text in one of the columns ``names`` that is no time?  (A null is no text.)"""
    found = F.lit(False)
    for name in names:
        found = found | (F.col(name).isNotNull() & to_utc_timestamp_col(df, name).isNull())
    return found
