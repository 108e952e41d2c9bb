"""Gaps as ranges, slot bitmaps, cascades and values that can't be read."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wickworks.operators import bitmaps, gaps, quality
from wickworks.operators.candles import cascade, resample
from wickworks.schema import OHLCV_SCHEMA, SERIES_KEY
from wickworks.sinks.lake import write_lake
from wickworks.sources.klines import klines_to_ohlcv
from wickworks.sources.lake import read_lake

T0 = datetime(2023, 11, 30, 20)


def _frame(spark, times, tf="1m", symbol="S"):
    return spark.createDataFrame([(t, symbol, tf, 1.0, 2.0, 0.5, 1.5, 1.0, "src", t) for t in times], OHLCV_SCHEMA)


def _minutes(seed, n=2500, span=4000):
    rng = random.Random(seed)
    kept = sorted(rng.sample(range(span), n))
    return [m for m in kept if not 900 <= m < 2100 and not 3000 <= m < 3001]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gaps_and_runs_over_many_blocks(spark):
    at = _minutes(1)
    rows = _frame(spark, [T0 + timedelta(minutes=m, seconds=m % 50) for m in at + at[:5]]).unionByName(_frame(spark, [T0, T0 + timedelta(days=3)], "2s", "U"))
    want = [(a + 1, b - 1, b - a - 1) for a, b in zip(at, at[1:]) if b > a + 1]
    minute = lambda t: round((t - T0).total_seconds() / 60)
    got = gaps.gap_ranges(rows)
    known = got.where("symbol = 'S'").collect()
    assert sorted((minute(r["gap_start"]), minute(r["gap_end"]), r["n_missing"]) for r in known) == want
    assert [tuple(r) for r in got.where("symbol = 'U'").collect()] == [("src", "U", "2s", None, None, None)]
    assert sum(r["n_missing"] for r in known) == quality.missing_candles(rows).where("event_time IS NOT NULL").count()
    runs, begin = [], at[0]
    for a, b in zip(at, [*at[1:], None]):
        if b != a + 1:
            runs.append((begin, a, a - begin + 1))
            begin = b
    assert sorted((minute(r["run_start"]), minute(r["run_end"]), r["n_candles"]) for r in gaps.candle_runs(rows).collect()) == runs
    windows = gaps.repair_windows(rows, limit=100).collect()
    assert sum(r["window_end"] - r["window_start"] for r in windows) == 60_000 * sum(n for *_, n in want)
    assert max(r["window_end"] - r["window_start"] for r in windows) == 6_000_000
    assert gaps.gap_ranges(rows.limit(0)).count() == gaps.candle_runs(rows.limit(0)).count() == 0


def test_gaps_of_weeks_and_months(spark):
    rows = _frame(spark, [datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 6, 1)], "1M").unionByName(_frame(spark, [datetime(2024, 1, 1), datetime(2024, 1, 29)], "1w"))
    got = {r["timeframe"]: (r["gap_start"], r["gap_end"], r["n_missing"]) for r in gaps.gap_ranges(rows).collect()}
    assert got == {"1M": (datetime(2024, 3, 1), datetime(2024, 5, 1), 3), "1w": (datetime(2024, 1, 8), datetime(2024, 1, 22), 3)}


@pytest.mark.parametrize("tf, step", [("1m", timedelta(minutes=1)), ("1h", timedelta(hours=1)), ("1w", timedelta(days=7)), ("3d", timedelta(days=3))])
def test_bitmaps_count_as_the_grid_does(spark, tf, step):
    start = datetime(2024, 1, 1) if tf == "1w" else datetime(2023, 12, 31, 22) if tf in ("1m", "1h") else datetime(2023, 10, 31)
    at = [i for i in _minutes(3, 1500, 2200)] + [60_000]
    rows = _frame(spark, [start + i * step for i in at if tf in ("1m", "1h") or i < 2200], tf)
    loads = [bitmaps.slot_bitmaps(rows.where(F.expr(c))) for c in ("minute(event_time) % 3 = 0", "minute(event_time) % 3 > 0", "day(event_time) = 5")]
    both = bitmaps.merge_bitmaps(*loads)
    grid, missing = quality.expected_grid(rows), quality.missing_candles(rows)
    month = [F.year("event_time").alias("year"), F.month("event_time").alias("month")]
    want = {tuple(r) for r in grid.groupBy(*SERIES_KEY, *month).count().collect()}
    lost = {tuple(r[:-1]): r[-1] for r in missing.groupBy(*SERIES_KEY, *month).count().collect()}
    got = bitmaps.months_of(both).collect()
    assert {tuple(r)[:-1] for r in got} == want and {tuple(r)[:-2]: r["n_missing"] for r in got if r["n_missing"]} == lost
    done = bitmaps.completeness_of(bitmaps.slot_bitmaps(rows))
    assert [tuple(r) for r in done.drop("missing").collect()] == [tuple(r) for r in quality.completeness(rows).collect()]
    assert done.first()["missing"] == missing.count() == bitmaps.completeness_of(both).first()["missing"]
    assert "Generate" not in _plan(bitmaps.completeness_of(both))
    assert bitmaps.completeness_of(bitmaps.slot_bitmaps(rows.limit(0))).count() == 0


def test_cascade_is_four_resamples_from_one_scan(spark, tmp_dir):
    rng = random.Random(5)
    rows = [(T0 + timedelta(minutes=m), s, "1m", *[float(rng.randrange(99)) for _ in range(4)], 1.0, "src", T0) for s in "AB" for m in _minutes(7)]
    spark.createDataFrame(rows, OHLCV_SCHEMA).write.parquet(tmp_dir + "/m")
    minutes = spark.read.parquet(tmp_dir + "/m")
    chain = cascade(minutes, ("5m", "1h", "4h", "1d"))
    rows = chain.collect()
    apart = [r for tf in ("5m", "1h", "4h", "1d") for r in resample(minutes, tf, "1m").collect()]
    assert sorted(map(tuple, rows)) == sorted(map(tuple, apart)) and len(rows) > 500
    plan = _plan(chain)
    assert "Generate" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan
    with pytest.raises(ValueError, match="can't be made"):
        cascade(minutes, ("1h", "5m"))


def test_time_text_that_is_no_time(spark, tmp_dir):
    rows = _frame(spark, [T0 + timedelta(hours=i) for i in range(20)], "1h")
    text = rows.withColumn("event_time", F.when(F.hour("event_time") % 5 == 0, F.lit("garbage")).otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))
    with pytest.raises(Exception, match="no time that can be read: garbage"):
        write_lake(text, tmp_dir + "/a")
    write_lake(text, tmp_dir + "/b", bad_times=tmp_dir + "/bad")
    bad = spark.read.parquet(tmp_dir + "/bad")
    assert bad.where("event_time = 'garbage'").count() == bad.count() == 5 and read_lake(spark, tmp_dir + "/b").count() == 15
    write_lake(rows.unionByName(rows.withColumn("close", F.lit(9.0))), tmp_dir + "/c")  # one row per key, whoever calls
    assert read_lake(spark, tmp_dir + "/c").count() == 20


def test_one_bad_kline_is_null_by_itself(spark):
    good = ["1704067200000", "1", "2", "0.5", "1.5", "10", "1704070799999", "5", "3", "2", "0", "0"]
    bad = [["x", *good[1:]], [good[0], "abc", *good[2:]], good[:3], [], good]
    rows = klines_to_ohlcv(spark.createDataFrame([(k,) for k in bad], "k array<string>"), "S", "1h", extras=True).collect()
    assert [r["event_time"] is None for r in rows] == [True, False, False, True, False]
    assert [r["open"] for r in rows] == [1.0, None, 1.0, None, 1.0] and [r["close"] for r in rows] == [1.5, 1.5, None, None, 1.5]
    assert [r["trades"] for r in rows] == [3, 3, None, None, 3]
