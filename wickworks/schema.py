"""The OHLCV data contract (version v1) and the timeframe tables.

Every candle DataFrame in this library carries the ten contract columns in
``OHLCV_COLUMNS`` order.  A *series* is the set of rows sharing ``SERIES_KEY``
ordered by ``event_time``; every window and scan partitions by that key.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The contract's version, columns and types, the store's layout,
# and the interval tables.

SCHEMA_VERSION = "v1"

OHLCV_COLUMNS = [
    "event_time",
    "symbol",
    "timeframe",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "source",
    "ingestion_time",
]

# Columns that must be non-null for a row to be valid (ingestion_time is not checked).
REQUIRED_COLUMNS = OHLCV_COLUMNS[:9]

PRICE_COLUMNS = ["open", "high", "low", "close"]

SERIES_KEY = ["source", "symbol", "timeframe"]

OHLCV_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("timeframe", T.StringType(), True),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.DoubleType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("ingestion_time", T.TimestampType(), True),
    ]
)

# Lake layout: partition directories in this order below the table root.
LAKE_PARTITIONS = ["source", "symbol", "timeframe", "year", "month"]

# Silver keeps the series key (the single-series notebook dropped it) plus year/month.
SILVER_COLUMNS = SERIES_KEY + ["event_time", "open", "high", "low", "close", "volume", "year", "month"]
INDICATOR_COLUMNS = ["sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist"]
GOLD_COLUMNS = SILVER_COLUMNS + INDICATOR_COLUMNS

# Extra kline fields (positions 7, 8, 9 of an exchange kline array).
KLINE_EXTRA_COLUMNS = ["quote_volume", "trades", "taker_buy_volume"]

# Interval code -> milliseconds.  "1M" is the exchange's approximate 30 days;
# calendar-correct month arithmetic uses INTERVAL 1 MONTH instead.
TIMEFRAME_MS = {
    "1m": 60_000,
    "3m": 180_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "2h": 7_200_000,
    "4h": 14_400_000,
    "6h": 21_600_000,
    "8h": 28_800_000,
    "12h": 43_200_000,
    "1d": 86_400_000,
    "3d": 259_200_000,
    "1w": 604_800_000,
    "1M": 2_592_000_000,
}

# Interval code -> candles per day used for the expected-candle estimate; codes
# missing here (3d, 1w, 1M and unknown ones) count as 24.
CANDLES_PER_DAY = {
    "1m": 1440,
    "3m": 480,
    "5m": 288,
    "15m": 96,
    "30m": 48,
    "1h": 24,
    "2h": 12,
    "4h": 6,
    "6h": 4,
    "8h": 3,
    "12h": 2,
    "1d": 1,
}
DEFAULT_CANDLES_PER_DAY = 24

# Exchange page size (klines per request) and the kline array positions used.
MAX_PAGE_LIMIT = 1000
KLINE_POSITIONS = {
    "open_time": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "close_time": 6,
    "quote_volume": 7,
    "trades": 8,
    "taker_buy_volume": 9,
}

# Writer default: rows per Parquet file.
DEFAULT_MAX_ROWS_PER_FILE = 200_000

# Indicator parameters of the gold layer.
SMA_WINDOW = 200
EMA_PERIOD = 50
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
RSI_PERIOD = 14
RSI_OVERSOLD, RSI_OVERBOUGHT = 30.0, 70.0
# ---------------------------------------------------------------------------


def ema_alpha(period: int) -> float:
    """Smoothing factor 2 / (period + 1) of an EMA over ``period`` rows."""
    return 2.0 / (period + 1.0)


def wilder_alpha(period: int) -> float:
    """Wilder's smoothing factor 1 / period (RSI averages)."""
    return 1.0 / period
