"""Indicators against the sequential definitions, incl. long multi-block series."""

import random
from datetime import datetime, timedelta

import pytest

from wickworks.operators.indicators import Ema, ema, indicators, row_index, sma
from wickworks.schema import OHLCV_SCHEMA


def _candles(spark, closes, symbol="S", tf="1h", start=datetime(2024, 1, 1), step=None, skip=()):
    step = step or {"1h": timedelta(hours=1), "1m": timedelta(minutes=1), "1d": timedelta(days=1)}[tf]
    rows, t = [], start
    for i, c in enumerate(closes):
        while i in skip:
            break
        rows.append((t, symbol, tf, c, c, c, c, 1.0, "src", t))
        t += step * (3 if i in skip else 1)
    return spark.createDataFrame(rows, OHLCV_SCHEMA)


def _ema(xs, a):
    out = []
    for i, x in enumerate(xs):
        if x is None or (out and out[-1] is None):
            out.append(None)
        else:
            out.append(x if i == 0 else a * x + (1 - a) * out[-1])
    return out


def _gold_ref(closes):
    e50, e12, e26 = _ema(closes, 2 / 51), _ema(closes, 2 / 13), _ema(closes, 2 / 27)
    macd = [p - q for p, q in zip(e12, e26)]
    sig = _ema(macd, 0.2)
    d = [0.0] + [closes[i] - closes[i - 1] for i in range(1, len(closes))]
    ag, al = _ema([max(x, 0) for x in d], 1 / 14), _ema([max(-x, 0) for x in d], 1 / 14)
    rsi = [None] + [100.0 if al[i] == 0 else 100 - 100 / (1 + ag[i] / al[i]) for i in range(1, len(closes))]
    sma = [sum(closes[max(0, i - 199): i + 1]) / len(closes[max(0, i - 199): i + 1]) for i in range(len(closes))]
    return dict(ema_50=e50, macd=macd, macd_signal=sig, rsi_14=rsi, sma_200=sma)


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_delta_and_rsi_head(spark):
    out = indicators(_candles(spark, [10.0, 11.0, 10.0, 12.0])).orderBy("event_time").collect()
    assert out[0].rsi_14 is None and out[1].rsi_14 == 100.0


def test_constant_series(spark):
    out = indicators(_candles(spark, [5.0] * 30)).orderBy("event_time").collect()
    assert out[0].rsi_14 is None and all(r.rsi_14 == 100.0 for r in out[1:])
    assert all(abs(r.macd) < 1e-12 and abs(r.macd_signal) < 1e-12 and abs(r.macd_hist) < 1e-12 for r in out)
    assert all(abs(r.ema_50 - 5.0) < 1e-12 for r in out)


def test_partial_sma(spark):
    out = sma(_candles(spark, [1.0, 2.0, 3.0])).orderBy("event_time").collect()
    assert [r.sma_200 for r in out] == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("tf,n", [("1m", 3000), ("1h", 1500)])
def test_long_series_matches_loop(spark, tf, n):
    """Series spanning many blocks and fold levels, with time gaps, two keys interleaved."""
    rnd = random.Random(7)
    a = [100 + rnd.uniform(-5, 5) for _ in range(n)]
    b = [50 + rnd.uniform(-2, 2) for _ in range(n // 2)]
    df = _candles(spark, a, "A", tf, skip={17, 600, 601, 1200}).unionByName(_candles(spark, b, "B", tf))
    got = indicators(df, keep_internal=True).orderBy("symbol", "event_time").collect()
    for sym, xs in (("A", a), ("B", b)):
        rows = [r for r in got if r.symbol == sym]
        ref = _gold_ref(xs)
        assert [r.idx for r in rows] == list(range(len(xs)))
        for name, vals in ref.items():
            for r, v in zip(rows, vals):
                assert _close(getattr(r, name), v, 1e-8), (sym, name, r.idx, getattr(r, name), v)
        for r, v in zip(rows[1:], ref["ema_50"][:-1]):
            assert _close(r.prev_ema_50, v, 1e-8)
        for r, v in zip(rows[1:], ref["sma_200"][:-1]):
            assert _close(r.prev_sma_200, v, 1e-8)
        assert rows[0].prev_ema_50 is None and rows[0].prev_sma_200 is None


def test_null_propagates(spark):
    xs = [float(i) for i in range(10)]
    xs[5] = None
    out = ema(_candles(spark, xs), [Ema("e", "close", 0.3)]).orderBy("event_time").collect()
    ref = _ema(xs, 0.3)
    assert all(_close(r.e, v) for r, v in zip(out, ref))
    assert all(r.e is None for r in out[5:])


def test_row_index(spark):
    out = row_index(_candles(spark, [1.0] * 700, tf="1m")).orderBy("event_time").collect()
    assert [r.idx for r in out] == list(range(700))


def test_no_window_without_partition_keys(spark):
    plan = indicators(_candles(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_overfull_buckets_use_sub_blocks(spark):
    """Rows denser than their timeframe (20 per hour labelled 1h) overfill buckets; the
    sub-blocks keep every block <= 512 rows and the results equal the loop."""
    rnd = random.Random(3)
    xs = [10 + rnd.uniform(-1, 1) for _ in range(3000)]
    df = _candles(spark, xs, "D", "1h", step=timedelta(minutes=3))
    out = indicators(df, keep_internal=True).orderBy("event_time").collect()
    ref = _gold_ref(xs)
    assert [r.idx for r in out] == list(range(len(xs)))
    for name, vals in ref.items():
        for r, v in zip(out, vals):
            assert _close(getattr(r, name), v, 1e-8), (name, r.idx)
