"""Scalar helpers."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wickworks import functions as W


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [("2024-01-01T02:00:00+02:00", 1704067200000, "1h", "2024-03-05")],
        "zoned string, ms long, tf string, d string",
    )
    r = df.select(
        W.to_utc_timestamp_col(df, "zoned").cast("string").alias("utc"),
        W.from_epoch_ms("ms").cast("string").alias("t"),
        W.to_epoch_ms(W.from_epoch_ms("ms")).alias("back"),
        W.timeframe_ms("tf").alias("tf_ms"),
        W.timeframe_ms(F.lit("1M")).alias("month_ms"),
        W.timeframe_ms(F.lit("1m")).alias("minute_ms"),
        W.candles_per_day("tf").alias("cpd"),
        W.candles_per_day(F.lit("1w")).alias("cpd_week"),
        W.parse_date_strict("d").alias("d"),
        W.zero_pad_month(F.lit(3)).alias("mm"),
        W.iso_text(W.from_epoch_ms("ms")).alias("iso"),
        W.day_number(W.from_epoch_ms("ms")).alias("day"),
        W.end_of_day_exclusive(F.lit("2024-01-31")).cast("string").alias("eod"),
    ).first()
    assert r.utc == "2024-01-01 00:00:00" and r.t == "2024-01-01 00:00:00" and r.back == 1704067200000
    assert (r.tf_ms, r.month_ms, r.minute_ms) == (3_600_000, 2_592_000_000, 60_000)
    assert (r.cpd, r.cpd_week) == (24, 24)
    assert r.d == date(2024, 3, 5) and r.mm == "03" and r.iso == "2024-01-01T00:00:00+00:00"
    assert r.day == pytest.approx(19723.0) and r.eod == "2024-02-01 00:00:00"


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert [r.y for r in df.select(W.nan_to_null("x").alias("y")).collect()] == [None, 1.5, None]


def test_ntz_input_is_utc_wall_clock(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5, 0),)], "t timestamp_ntz")
    assert df.select(W.to_utc_timestamp_col(df, "t").cast("string").alias("u")).first().u == "2024-01-01 05:00:00"


def test_to_double_is_ansi_safe(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,)], "s string")
    assert [r.d for r in df.select(W.to_double("s").alias("d")).collect()] == [1.5, None, None]


def test_checkpoint_folder_is_required_off_a_local_master(spark, monkeypatch):
    import types

    import pytest

    from wickworks import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    far = types.SimpleNamespace(sparkContext=Context(), conf=types.SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(far)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_null_series_key_and_wrong_targets_raise(spark):
    import pytest

    from wickworks.operators.candles import resample
    from wickworks.operators.indicators import row_index
    from wickworks.schema import OHLCV_SCHEMA
    from wickworks.sources.klines import fetch_windows

    rows = spark.sql("SELECT timestamp'2024-01-01' AS event_time, CAST(NULL AS STRING) AS symbol, '1h' AS timeframe, 's' AS source, 1D AS close")
    with pytest.raises(Exception, match="null series key: symbol"):
        row_index(rows).collect()
    with pytest.raises(ValueError, match="can't be made"):
        resample(spark.createDataFrame([], OHLCV_SCHEMA), "4h", "3d")
    with pytest.raises(Exception, match="Invalid interval: 2m"):
        fetch_windows(spark.createDataFrame([("a", "2m", 0, 10)], "symbol string, interval string, start_ms long, end_ms long")).collect()
