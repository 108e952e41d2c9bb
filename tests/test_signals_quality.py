"""Crosses, zones, geometry, gaps and fill."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wickworks.operators import quality, signals
from wickworks.schema import OHLCV_SCHEMA


def _series(spark, cols, values, tf="1h", t0=datetime(2024, 1, 1)):
    rows = []
    for i, v in enumerate(values):
        rows.append((t0 + timedelta(hours=i), "S", tf, "src", *v))
    return spark.createDataFrame(rows, ["event_time", "symbol", "timeframe", "source", *cols])


def test_ma_cross(spark):
    diffs = [-1.0, 0.0, 1.0, 1.0, -1.0]
    df = _series(spark, ["ema_50", "sma_200"], [(d, 0.0) for d in diffs])
    out = signals.crosses(df, "ema_50", "sma_200").orderBy("event_time").collect()
    assert [r.cross_up for r in out] == [False, False, True, False, False]
    assert [r.cross_down for r in out] == [False, False, False, False, True]


def test_rsi_zones(spark):
    df = _series(spark, ["rsi"], [(29.9,), (30.0,), (70.0,), (70.1,), (None,)])
    z = [r.z for r in df.select(signals.rsi_zone("rsi").alias("z"), "event_time").orderBy("event_time").collect()]
    assert z == ["oversold", None, None, "overbought", None]


def test_geometry(spark):
    df = _series(spark, ["open", "high", "low", "close"], [(1.0, 2.0, 0.5, 1.0), (2.0, 2.5, 0.5, 1.0)])
    out = signals.candle_geometry(df).orderBy("event_time").collect()
    assert out[0].is_up and not out[1].is_up
    assert out[1].body_low == 1.0 and out[1].body_height == 1.0 and out[1].wick_high == 2.5


def _candles(spark, hours):
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(hours=h), "S", "1h", float(h), float(h), float(h), float(h), 1.0, "src", t0) for h in hours]
    return spark.createDataFrame(rows, OHLCV_SCHEMA)


def test_missing_and_fill(spark):
    df = _candles(spark, [0, 1, 4, 5, 9])
    miss = sorted(r.event_time.hour for r in quality.missing_candles(df).collect())
    assert miss == [2, 3, 6, 7, 8]
    filled = quality.gap_fill(df).orderBy("event_time").collect()
    assert len(filled) == 10
    assert [r.close for r in filled] == [0, 1, 1, 1, 4, 5, 5, 5, 5, 9]
    assert [r.is_filled for r in filled].count(True) == 5 and filled[2].volume == 0.0
    c = quality.completeness(df).collect()[0]
    assert c.present == 5 and c.expected == 10 and c.estimated == 24


def test_per_year_lag(spark):
    t0 = datetime(2023, 12, 31, 22)
    rows = [(t0 + timedelta(hours=i), "S", "1h", "src", float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, ["event_time", "symbol", "timeframe", "source", "v"]).withColumn("year", F.year("event_time"))
    out = signals.with_prev(df, ["v"], per_year=True).orderBy("event_time").collect()
    assert [r.prev_v for r in out] == [None, 0.0, None, 2.0]


def test_calendar_month_and_week_grids(spark):
    rows = []
    for tf, times in (("1M", [datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 5, 1)]),
                      ("1w", [datetime(2024, 1, 1), datetime(2024, 1, 22)])):
        for t in times:
            rows.append((t, "S", tf, 1.0, 1.0, 1.0, 1.0, 1.0, "src", t))
    df = spark.createDataFrame(rows, OHLCV_SCHEMA)
    miss = sorted((r.timeframe, r.event_time.replace(tzinfo=None)) for r in quality.missing_candles(df).collect())
    assert miss == [("1M", datetime(2024, 3, 1)), ("1M", datetime(2024, 4, 1)),
                    ("1w", datetime(2024, 1, 8)), ("1w", datetime(2024, 1, 15))]
    comp = {r.timeframe: (r.present, r.expected) for r in quality.completeness(df).collect()}
    assert comp == {"1M": (3, 5), "1w": (2, 4)}
