"""Merges that touch few months, gold that goes on from kept states, on stores and on streams."""

import os
import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wickworks.operators.indicators import indicators, indicators_from
from wickworks.plans.incremental import affected, read_gold, read_states, update_gold
from wickworks.plans.merge import in_months, merge_months, touched_months
from wickworks.schema import GOLD_COLUMNS, OHLCV_COLUMNS, OHLCV_SCHEMA, SERIES_KEY
from wickworks.sinks.lake import write_lake
from wickworks.sources.lake import read_lake
from wickworks.streaming import carried, upsert, versions
from wickworks.streaming.candles import run_ema, run_to_parquet, stream_keep_last

T0 = datetime(2020, 1, 1)


def _candles(spark, days, symbols=("A", "007"), start=0, bump=0.0, step=1, nulls=()):
    rows = []
    for s in symbols:
        for i in range(start, start + days, step):
            close = None if i in nulls else 100.0 + (i * 37 % 101) + bump + len(s)
            rows.append((T0 + timedelta(days=i), s, "1d", 99.0, 300.0, 1.0, close, 10.0, "src", T0))
    random.Random(days).shuffle(rows)
    return spark.createDataFrame(rows, OHLCV_SCHEMA)


def _rows(df, columns=GOLD_COLUMNS):
    out = {}
    for r in df.select(*columns).collect():
        key = (r["symbol"], r["timeframe"], r["event_time"])
        assert key not in out
        out[key] = [round(v, 8) if isinstance(v, float) else v for v in r]
    return out


def _full_gold(spark, lake):
    return _rows(indicators(read_lake(spark, lake)))


def _stored(spark, df, folder):
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _files_read(df):
    """Files that the scan of ``df`` lists after its partition filters."""
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    parts = scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters())
    return [parts.apply(i).files().apply(j).getPath().toString() for i in range(parts.length()) for j in range(parts.apply(i).files().length())]


def test_a_merge_reads_only_the_months_it_touches(spark, tmp_dir):
    lake = os.path.join(tmp_dir, "lake")
    write_lake(_candles(spark, 900), lake, mode="overwrite")
    all_files = read_lake(spark, lake).inputFiles()
    new = _stored(spark, _candles(spark, 3, ("A",), start=500, bump=7.0), os.path.join(tmp_dir, "new"))
    months = touched_months(new)
    frame = in_months(read_lake(spark, lake), months)
    assert len(all_files) == 60 and len(months) == 1
    read = _files_read(frame)
    assert len(read) == 1 and "symbol=A/" in read[0] and "year=2021/month=05" in read[0]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "concat_ws" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    before = {f: os.path.getmtime(f.removeprefix("file://")) for f in all_files}
    done = merge_months(spark, lake, new)
    now = read_lake(spark, lake)
    assert len(done.files) == 1 and os.path.isdir(done.staged) and now.count() == 1800
    assert sum(os.path.exists(f.removeprefix("file://")) and os.path.getmtime(f.removeprefix("file://")) == t for f, t in before.items()) == 59
    assert now.where((F.col("symbol") == "A") & F.col("close").between(100 + 7, 400) & (F.col("event_time") == T0 + timedelta(days=501))).first()["close"] == 100.0 + 501 * 37 % 101 + 7 + 1
    assert merge_months(spark, lake, new.limit(0)).months == []


def test_gold_of_a_growing_store(spark, tmp_dir):
    lake, gold = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "gold")
    steps = [
        _candles(spark, 300), _candles(spark, 150, start=300),
        _candles(spark, 40, ("A",), start=200, bump=5.0, nulls=(230,)),  # an old month of one series, with a null from then on
        _candles(spark, 20, ("new",), start=460).unionByName(_candles(spark, 5, start=450, step=2)),
    ]
    for n, rows in enumerate(steps):
        before = {} if not n else {(r["symbol"], r["year"], r["month"]): r["last_time"] for r in read_states(spark, gold).collect()}
        done = merge_months(spark, lake, _stored(spark, rows, os.path.join(tmp_dir, f"new{n}")))
        update_gold(spark, lake, gold, done.months)
        assert _rows(read_gold(spark, gold)) == _full_gold(spark, lake)
        states = {(r["symbol"], r["year"], r["month"]): r["last_time"] for r in read_states(spark, gold).collect()}
        assert set(before) <= set(states) and len(states) == read_lake(spark, lake).select("symbol", "year", "month").distinct().count()
    update_gold(spark, lake, gold, done.months)  # an update done again changes nothing
    assert _rows(read_gold(spark, gold)) == _full_gold(spark, lake)
    # what an update reads: the touched series from the first touched month on
    files = _files_read(affected(spark, lake, touched_months(_candles(spark, 1, ("007",), start=400))))
    assert files and all("symbol=007/" in f and "year=2021" in f for f in files) and len(files) < len(read_lake(spark, lake).inputFiles()) / 4


def test_parts_of_any_length_give_the_whole(spark):
    df = _candles(spark, 420, nulls=(380,)).cache()
    whole, cuts = _rows(indicators(df, keep_internal=True), [*OHLCV_COLUMNS, "idx", "prev_macd_signal", "prev_close", "rsi_14", "sma_200", "ema_50", "macd_signal"]), [0, 1, 2, 203, 420]
    states, got = None, {}
    for a, b in zip(cuts, cuts[1:]):
        part = df.where((F.col("event_time") >= T0 + timedelta(days=a)) & (F.col("event_time") < T0 + timedelta(days=b)))
        rows, ends = indicators_from(part, states, keep_internal=True)
        got |= _rows(rows, [*OHLCV_COLUMNS, "idx", "prev_macd_signal", "prev_close", "rsi_14", "sma_200", "ema_50", "macd_signal"])
        states = ends.groupBy(*SERIES_KEY).agg(F.max_by("state", F.struct("_bucket", "_sub")).alias("state"))
    assert got == whole


def test_streamed_gold_late_rows_and_lost_states(spark, tmp_dir):
    landed, out, checkpoint = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    df = _candles(spark, 260).cache()
    t = F.col("event_time")
    cut = lambda a, b: df.where((t >= T0 + timedelta(days=a)) & (t < T0 + timedelta(days=b)))

    def run(rows):
        rows.coalesce(1).write.mode("append").parquet(landed)
        carried.run_gold(spark.readStream.schema(df.schema).parquet(landed), out, checkpoint)

    run(cut(0, 100))
    run(cut(100, 250).unionByName(cut(40, 45)))
    run(cut(250, 260).where("symbol = 'A'"))
    run(cut(250, 260).where("symbol = '007'"))
    got = carried.read_gold_stream(spark, out)
    columns = ["symbol", "timeframe", "event_time", "close", "sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist"]
    assert _rows(got, columns) == _rows(indicators(df), columns)
    assert {r["symbol"]: r["late"] for r in carried.read_late_candles(spark, out).collect()} == {"A": 5, "007": 5}
    assert sorted(os.listdir(f"{checkpoint}/series")) == ["batch=2", "batch=3"]
    shutil.move(f"{checkpoint}/series/batch=3", os.path.join(tmp_dir, "lost"))
    with pytest.raises(Exception, match="needs the state of batch 3"):
        run(cut(0, 1))
    assert versions.state_before(spark, f"{checkpoint}/series", 0) is None


def test_lost_state_of_the_streamed_ema(spark, tmp_dir):
    landed, out, checkpoint = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    for day in (0, 10):
        _candles(spark, 10, start=day).write.mode("append").parquet(landed)
        if day:
            shutil.move(f"{checkpoint}/series", os.path.join(tmp_dir, "lost"))
            with pytest.raises(Exception, match="needs the state of batch 0"):
                run_ema(spark.readStream.schema(OHLCV_SCHEMA).parquet(landed), out, checkpoint, 0.1)
        else:
            run_ema(spark.readStream.schema(OHLCV_SCHEMA).parquet(landed), out, checkpoint, 0.1)


def test_last_versions_on_a_stream(spark, tmp_dir):
    landed, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    old, new = _candles(spark, 5).withColumn("seq", F.lit(1)), _candles(spark, 3, bump=50.0).withColumn("seq", F.lit(2))
    for rows in (new, old, _candles(spark, 1, start=9).withColumn("seq", F.lit(1))):
        rows.write.mode("append").parquet(landed)
    run_to_parquet(stream_keep_last(spark.readStream.schema(old.schema).parquet(landed)), out, os.path.join(tmp_dir, "ckpt"))
    got = {(r["symbol"], (r["event_time"] - T0).days): r["seq"] for r in spark.read.parquet(out).collect()}
    assert got == {(s, d): 2 if d < 3 else 1 for s in ("A", "007") for d in range(5)}
    with pytest.raises(ValueError, match="must be a key"):
        stream_keep_last(old, SERIES_KEY)


def test_candles_revised_by_late_ticks_and_repeated_batches(spark, tmp_dir):
    landed, out, checkpoint = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    rng = random.Random(4)
    ticks = [("s", "A", T0 + timedelta(seconds=rng.randrange(20_000)), float(rng.randrange(100)), 1.0, i) for i in range(400)]
    schema = "source string, symbol string, ts timestamp, price double, size double, seq long"
    for i in range(7):
        spark.createDataFrame(ticks[i::7], schema).coalesce(1).write.mode("append").parquet(landed)
        upsert.run_candles(spark.readStream.schema(schema).parquet(landed), out, checkpoint, "1h", compact_every=2)
    first = sorted(map(tuple, upsert.read_candles(spark, out).collect()))
    want = {}
    for _, _, ts, price, size, seq in sorted(ticks, key=lambda t: (t[2], t[5])):
        c = want.setdefault(ts.replace(minute=0, second=0), [price, price, price, price, 0.0, ts])
        want[ts.replace(minute=0, second=0)] = [c[0], max(c[1], price), min(c[2], price), price, c[4] + size, ts]
    assert first == sorted((t, "A", "1h", *c[:5], "s", c[5]) for t, c in want.items())
    spark.createDataFrame(ticks[6::7], schema)
    upsert.partial_candles(spark.createDataFrame(ticks[6::7], schema), "1h").write.mode("overwrite").parquet(f"{out}/parts/batch=6")  # the last batch once more
    assert sorted(map(tuple, upsert.read_candles(spark, out).collect())) == first
    assert len(os.listdir(f"{out}/base")) == 2 and len(os.listdir(f"{out}/parts")) < 7
