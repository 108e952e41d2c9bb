"""Column-level helpers: every function returns a JVM-side ``Column`` expression."""

from wickworks.functions.numeric import nan_to_null, to_double
from wickworks.functions.time import (
    candles_per_day,
    day_number,
    end_of_day_exclusive,
    from_epoch_ms,
    iso_text,
    parse_date_strict,
    timeframe_ms,
    to_epoch_ms,
    to_ntz,
    to_utc_timestamp_col,
    zero_pad_month,
)

__all__ = [
    "candles_per_day",
    "day_number",
    "end_of_day_exclusive",
    "from_epoch_ms",
    "iso_text",
    "nan_to_null",
    "parse_date_strict",
    "timeframe_ms",
    "to_double",
    "to_epoch_ms",
    "to_ntz",
    "to_utc_timestamp_col",
    "zero_pad_month",
]
