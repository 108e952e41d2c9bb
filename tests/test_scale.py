"""Scale properties: a hot series is spread over many tasks; streaming state spans micro-batches."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wickworks.operators.indicators import Ema, ema, indicators
from wickworks.operators.scan import add_blocks, materialize
from wickworks.schema import OHLCV_SCHEMA, SERIES_KEY, ema_alpha


def _series(spark, n, symbol, tf="1m"):
    t0 = datetime(2024, 1, 1)
    step = timedelta(minutes=1)
    return spark.range(n).select(
        (F.lit(t0) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp").alias("event_time"),
        F.lit(symbol).alias("symbol"), F.lit(tf).alias("timeframe"),
        *[(F.lit(100.0) + F.sin(F.col("id") / 50.0)).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"), F.lit("src").alias("source"), F.lit(t0).cast("timestamp").alias("ingestion_time"),
    ).select([f.name for f in OHLCV_SCHEMA.fields])


def test_hot_series_spreads_over_tasks(spark):
    """One series with 40k rows next to a tiny one: its rows land in many (series, bucket)
    partitions of the materialized table, never in a single task."""
    hot = _series(spark, 40_000, "HOT")
    cold = _series(spark, 50, "COLD")
    blocked, plan = materialize(add_blocks(hot.unionByName(cold), SERIES_KEY, ["event_time"]), SERIES_KEY)
    assert plan.levels == 2  # 40k minutes in 512-minute buckets: 79 buckets > 64
    parts = blocked.where(F.col("symbol") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts == n  # every task holds a share of the hot series
    biggest = blocked.groupBy("source", "symbol", "timeframe", "_bucket", "_sub").count().agg(F.max("count")).first()[0]
    assert biggest <= 512


def test_hot_series_ema_exact(spark):
    n = 20_000
    df = _series(spark, n, "HOT")
    out = ema(df, [Ema("e", "close", 0.2)]).orderBy("event_time").select("close", "e").collect()
    y = None
    worst = 0.0
    for i, r in enumerate(out):
        y = r.close if i == 0 else 0.2 * r.close + 0.8 * y
        worst = max(worst, abs(r.e - y))
    assert worst < 1e-9


def test_stream_ema_state_across_batches(spark, tmp_dir):
    """Candles land in three files; one file per micro-batch; EMA state carries over."""
    from wickworks.streaming.candles import read_ema, read_late, run_ema

    src = os.path.join(tmp_dir, "in")
    c = _series(spark, 300, "S", tf="1m")
    for k in range(3):
        c.where(F.floor((F.minute("event_time") + F.hour("event_time") * 60) / 100) == k).coalesce(1) \
            .write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out_dir = os.path.join(tmp_dir, "out")
    run_ema(stream, out_dir, os.path.join(tmp_dir, "ck"), ema_alpha(50), "ema_50")
    got = read_ema(spark, out_dir).orderBy("event_time").collect()
    assert len(got) == 300 and read_late(spark, out_dir).count() == 0
    y = None
    for i, r in enumerate(got):
        y = r.close if i == 0 else (2 / 51) * r.close + (1 - 2 / 51) * y
        assert abs(r.ema_50 - y) < 1e-9


def test_stream_ema_counts_late_rows(spark, tmp_dir):
    from wickworks.streaming.candles import read_ema, read_late, run_ema

    src = os.path.join(tmp_dir, "in")
    c = _series(spark, 100, "S", tf="1m")
    c.where(F.col("event_time") < F.lit("2024-01-01 01:00:00").cast("timestamp")).coalesce(1).write.parquet(src)
    late = c.where(F.col("event_time") < F.lit("2024-01-01 00:10:00").cast("timestamp")).withColumn("close", F.lit(1e6))
    late.unionByName(c.where(F.col("event_time") >= F.lit("2024-01-01 01:00:00").cast("timestamp"))) \
        .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out_dir = os.path.join(tmp_dir, "out")
    run_ema(stream, out_dir, os.path.join(tmp_dir, "ck"), 0.1, "e")
    got = read_ema(spark, out_dir).orderBy("event_time").collect()
    assert read_late(spark, out_dir).collect()[0]["late"] == 10
    assert len(got) == 100 and max(r.close for r in got) < 1e5
    y = None
    for i, r in enumerate(got):
        y = r.close if i == 0 else 0.1 * r.close + 0.9 * y
        assert abs(r.e - y) < 1e-9


def test_pass_table_gets_more_buckets_when_its_rows_need_them(spark, monkeypatch):
    from wickworks.operators import scan

    rows = spark.range(3000).selectExpr("timestamp_seconds(id * 60) AS event_time", "'S' AS symbol", "'s' AS source", "'1m' AS timeframe", "CAST(id % 97 AS double) AS close")
    want = {r["event_time"]: r["idx"] for r in indicators(rows, keep_internal=True).collect()}
    before = scan.pass_tables(spark)
    monkeypatch.setattr(scan, "ROWS_PER_BUCKET", 300)
    got = indicators(rows, keep_internal=True)
    made = scan.pass_tables(spark) - before
    assert len(made) == 1
    shown = spark.sql(f"DESCRIBE TABLE EXTENDED {made.pop()}").where("col_name = 'Num Buckets'").first()["data_type"]
    assert int(shown) == 10 and {r["event_time"]: r["idx"] for r in got.collect()} == want
    scan.release(spark, keep=before)
    assert scan.pass_tables(spark) == before
