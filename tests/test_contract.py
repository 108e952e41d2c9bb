"""Contract: kline conversion, typed frames, validation (ports of the reference's unit tests)."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from wickworks.operators import contract
from wickworks.schema import OHLCV_COLUMNS, OHLCV_SCHEMA
from wickworks.sources import klines

KLINE = [1704067200000, "42000.00", "42500.00", "41800.00", "42200.00", "1000.5", 1704070799999,
         "42100000.00", 5000, "500.25", "21050000.00", "0"]


def _row(**kw):
    base = dict(event_time=datetime(2024, 1, 1, tzinfo=timezone.utc), symbol="BTCUSDT", timeframe="1h",
                open=42000.0, high=42500.0, low=41800.0, close=42200.0, volume=1000.0, source="binance",
                ingestion_time=datetime(2024, 1, 2, tzinfo=timezone.utc))
    base.update(kw)
    return base


def _frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in OHLCV_COLUMNS) for r in rows], OHLCV_SCHEMA)


def test_kline_conversion(spark):
    import json

    pages = spark.createDataFrame([(json.dumps([KLINE]),)], "value string")
    rows = klines.explode_pages(pages.select(F.from_json("value", klines.PAGE_TYPE).alias("page")))
    out = klines.klines_to_ohlcv(rows, "BTCUSDT", "1h", extras=True).collect()[0]
    assert out.symbol == "BTCUSDT" and out.timeframe == "1h" and out.source == "binance"
    assert (out.open, out.high, out.low, out.close, out.volume) == (42000.0, 42500.0, 41800.0, 42200.0, 1000.5)
    assert out.event_time.replace(tzinfo=None) == datetime(2024, 1, 1)
    assert out.trades == 5000 and out.quote_volume == 42100000.0 and out.taker_buy_volume == 500.25


def test_frame_column_order(spark):
    df = contract.to_contract(_frame(spark, [_row()]))
    assert df.columns == OHLCV_COLUMNS
    assert df.count() == 1


def test_valid_batch(spark):
    df = _frame(spark, [_row()]).drop("ingestion_time")
    assert contract.validate(df).count() == 1
    assert contract.validation_messages(df).count() == 0


def test_invalid_high(spark):
    df = _frame(spark, [_row(open=42000.0, high=41000.0, low=40000.0, close=42200.0)])
    assert contract.validate(df).count() == 0
    msgs = [r.message for r in contract.validation_messages(df).collect()]
    assert any("high < max(open, close)" in m for m in msgs)


def test_nulls_nan_and_rules(spark):
    rows = [
        _row(close=None),
        _row(symbol=None),
        _row(high=float("nan")),
        _row(volume=-1.0),
        _row(low=42100.0),
        _row(high=41700.0, open=41700.0, close=41700.0, low=41800.0),
        _row(),
    ]
    df = _frame(spark, rows)
    assert contract.validate(df).count() == 1
    c = contract.violation_counts(df).collect()[0]
    assert c.null_close == 1 and c.null_symbol == 1 and c.null_high == 1
    assert c.negative_volume == 1 and c.low_above_body == 2 and c.high_below_low == 1
    # the null-close row is not counted as a high/low violation
    assert c.high_below_body == 0


def test_strict_profile_negative_price(spark):
    df = _frame(spark, [_row(open=-1.0, low=-2.0)])
    assert contract.validate(df).count() == 1
    assert contract.validate(df, strict=True).count() == 0


def test_missing_column_returns_unfiltered(spark):
    df = _frame(spark, [_row(high=1.0)]).drop("volume")
    assert contract.validate(df).count() == 1
    msgs = [r.message for r in contract.validation_messages(df).collect()]
    assert len(msgs) == 1 and msgs[0].startswith("Missing required columns")


def test_invalid_interval():
    with pytest.raises(ValueError, match="Invalid interval"):
        contract.check_interval("invalid")


def test_empty_frame(spark):
    df = contract.empty_ohlcv(spark)
    assert df.columns == OHLCV_COLUMNS and contract.validate(df).count() == 0


def test_fetch_windows(spark):
    req = spark.createDataFrame([("BTCUSDT", "1h", 0, 3_600_000 * 2500)], "symbol string, interval string, start_ms long, end_ms long")
    w = klines.fetch_windows(req).orderBy("window_start").collect()
    assert [r.window_start for r in w] == [0, 3_600_000_000, 7_200_000_000]
    assert w[-1].window_end == 3_600_000 * 2500


def test_fetch_windows_calendar_months(spark):
    from datetime import datetime, timezone

    def ms(y, m):
        return int(datetime(y, m, 1, tzinfo=timezone.utc).timestamp() * 1000)

    req = spark.createDataFrame([("BTCUSDT", "1M", ms(2020, 1), ms(2024, 1))], "symbol string, interval string, start_ms long, end_ms long")
    w = klines.fetch_windows(req, limit=12).orderBy("window_start").collect()
    assert [r.window_start for r in w] == [ms(2020, 1), ms(2021, 1), ms(2022, 1), ms(2023, 1)]
    assert [r.window_end for r in w] == [ms(2021, 1), ms(2022, 1), ms(2023, 1), ms(2024, 1)]


def test_assert_valid_raises(spark):
    ok = _frame(spark, [_row()])
    assert contract.assert_valid(ok) is ok
    with pytest.raises(ValueError, match="high < max"):
        contract.assert_valid(_frame(spark, [_row(high=1.0)]))
    with pytest.raises(ValueError, match="violate"):
        contract.assert_valid(_frame(spark, [_row(open=-1.0, low=-2.0)]))
