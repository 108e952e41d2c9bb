"""Backfill from landed pages (stands in for the reference's live-network test)."""

import json
import os

from pyspark.sql import functions as F

from wickworks.plans import backfill
from wickworks.schema import OHLCV_COLUMNS
from wickworks.sources.lake import read_partition

T0_MS = 1704067200000  # 2024-01-01 00:00 UTC
HOUR = 3_600_000


def _kline(i, bump=0.0):
    o = 42000.0 + i + bump
    return [T0_MS + i * HOUR, f"{o:.2f}", f"{o + 500:.2f}", f"{o - 200:.2f}", f"{o + 200:.2f}", f"{1000 + i}.5",
            T0_MS + (i + 1) * HOUR - 1, "1.0", 10, "0.5", "0.5", "0"]


def test_backfill_two_days(spark, tmp_dir):
    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    # two pages of 24 klines each, plus a re-landed copy of the last 4 hours and one broken kline
    with open(os.path.join(pages, "p0.json"), "w") as f:
        json.dump([_kline(i) for i in range(24)], f)
    with open(os.path.join(pages, "p1.json"), "w") as f:
        json.dump([_kline(i) for i in range(24, 48)], f)
    bad = _kline(50)
    bad[2] = "1.00"  # high below open/close -> invalid
    with open(os.path.join(pages, "p2.json"), "w") as f:
        json.dump([_kline(i, bump=7.0) for i in range(44, 48)] + [bad], f)
    with open(os.path.join(pages, "p3.json"), "w") as f:
        f.write(json.dumps([_kline(i) for i in range(3)])[:50])  # cut off on its way
    lake = os.path.join(tmp_dir, "lake")
    stats = backfill.run(spark, pages, lake, "BTCUSDT", "1h", "2024-01-01", "2024-01-03")
    assert stats["total_records"] == 54 and stats["valid_records"] == 52 and stats["invalid_records"] == 2
    assert stats["unparsed_pages"] == 1 and len(stats["files_written"]) == 1 and stats["duration_seconds"] > 0
    assert any("high < max(open, close)" in e for e in stats["validation_errors"])
    df = read_partition(spark, lake, "binance", "BTCUSDT", "1h", 2024, 1)
    rows = df.collect()
    assert df.columns == OHLCV_COLUMNS
    assert len(rows) == 48
    times = [r.event_time for r in rows]
    assert times == sorted(times) and len(set(times)) == 48
    for r in rows:
        assert r.high >= max(r.open, r.close) and r.low <= min(r.open, r.close) and r.volume >= 0
    assert df.where(F.col("symbol") != "BTCUSDT").count() == 0
    # what landed last stays
    assert [r.open for r in rows[-5:]] == [42043.0, 42051.0, 42052.0, 42053.0, 42054.0]


def test_a_range_leaves_the_rest_of_its_month(spark, tmp_dir):
    month, two_days = os.path.join(tmp_dir, "month"), os.path.join(tmp_dir, "two-days")
    for folder, bump in ((month, 0.0), (two_days, 5.0)):
        os.makedirs(folder)
        with open(os.path.join(folder, "p.json"), "w") as f:
            json.dump([_kline(i, bump) for i in range(31 * 24)], f)
    lake = os.path.join(tmp_dir, "lake")
    backfill.run(spark, month, lake, "BTCUSDT", "1h", "2024-01-01", "2024-01-31")
    backfill.run(spark, two_days, lake, "BTCUSDT", "1h", "2024-01-10", "2024-01-11")
    rows = read_partition(spark, lake, "binance", "BTCUSDT", "1h").collect()
    assert len(rows) == 31 * 24
    assert all(r.open == 42000.0 + i + (5.0 if 9 * 24 <= i < 11 * 24 else 0.0) for i, r in enumerate(rows))
