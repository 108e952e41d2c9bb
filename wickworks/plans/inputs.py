"""Candle inputs derived from the driver's tables, as Spark DataFrames and as the
equivalent SQL (for the DuckDB oracle).  Both sides must define the same rows.

* ``candles``: hourly candles of ``events`` (symbol = event_type).
* ``landed``: two overlapping ingestion runs — run 1 over events before
  2024-01-20 (ingested 2024-02-01, seq 1) and run 2, a corrected feed with
  prices rounded to 0.1, over events from 2024-01-15 on (ingested 2024-02-02,
  seq 2).  Together they cover every event; in the overlap keep-last must
  return run 2's values.
* ``dirty``: one 1-minute row per event with rule-based defects (null symbol,
  null close, NaN high, bad high/low, negative volume/price) for validation.
* ``daily``: daily candles of ``orders`` (symbol = o_orderpriority), 1995-2001.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.candles import ticks_to_candles
from wickworks.operators.dedup import dedup_last
from wickworks.schema import OHLCV_COLUMNS
from wickworks.sources.tables import event_ticks, lineitem_ticks, order_ticks, table

RUN1_TS = "2024-02-01 00:00:00"
RUN2_TS = "2024-02-02 00:00:00"
RUN1_END = "2024-01-20 00:00:00"
RUN2_START = "2024-01-15 00:00:00"


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_candles(event_ticks(spark, sf_dir), "1h")


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = event_ticks(spark, sf_dir)
    run1 = (
        ticks_to_candles(ticks.where(F.col("ts") < F.lit(RUN1_END).cast("timestamp")), "1h")
        .withColumn("ingestion_time", F.to_timestamp(F.lit(RUN1_TS)))
        .withColumn("seq", F.lit(1))
    )
    corrected = ticks.where(F.col("ts") >= F.lit(RUN2_START).cast("timestamp")).withColumn("price", F.round("price", 1))
    run2 = (
        ticks_to_candles(corrected, "1h")
        .withColumn("ingestion_time", F.to_timestamp(F.lit(RUN2_TS)))
        .withColumn("seq", F.lit(2))
    )
    return run1.unionByName(run2)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_last(landed(spark, sf_dir)).drop("seq")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_candles(order_ticks(spark, sf_dir), "1d")


def line_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles of ``lineitem`` lines (symbol = returnflag || linestatus)."""
    return ticks_to_candles(lineitem_ticks(spark, sf_dir), "1d")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, uid, v = F.col("event_id"), F.col("user_id"), F.col("value")
    base = ev.select(
        eid.alias("event_id"),
        uid.alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(eid % 67 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("symbol"),
        F.when(eid % 73 == 0, -v).otherwise(v).alias("open"),
        F.when(eid % 89 == 0, F.lit(None).cast("double")).otherwise(v + ((eid % 7) - 3) * 0.5).alias("close"),
    )
    o, c = F.col("open"), F.col("close")
    out = base.select(
        "event_time",
        "symbol",
        F.lit("1m").alias("timeframe"),
        "open",
        F.when(eid % 97 == 0, F.least(o, c) - 1.0)
        .when(eid % 71 == 0, F.lit(float("nan")))
        .otherwise(F.greatest(o, c) + (uid % 5) * 0.25)
        .alias("high"),
        F.when(eid % 79 == 0, F.greatest(o, c) + 1.0).otherwise(F.least(o, c) - (uid % 3) * 0.25).alias("low"),
        "close",
        F.when(eid % 83 == 0, -1.0 - (uid % 11)).otherwise((uid % 11) * 1.5).alias("volume"),
        F.lit("events").alias("source"),
        (F.col("event_time") + F.expr("INTERVAL 1 MINUTE")).alias("ingestion_time"),
    )
    return out.select(*OHLCV_COLUMNS)


# --------------------------------------------------------------------------- SQL

CANDLES_SQL = """
SELECT 'events' AS source, event_type AS symbol, '1h' AS timeframe,
       date_trunc('hour', ts) AS event_time,
       arg_min(price, (ts, event_id, price)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id, price)) AS close, sum(size) AS volume, max(ts) AS ingestion_time
FROM (SELECT *, {price} AS price, value AS size FROM events) {where}
GROUP BY 1, 2, 3, 4
"""


def candles_sql(where: str = "", ingestion: str | None = None, corrected: bool = False) -> str:
    q = CANDLES_SQL.format(where=where, price="round(value, 1)" if corrected else "value")
    if ingestion is None:
        return q
    return f"SELECT * REPLACE (TIMESTAMP '{ingestion}' AS ingestion_time) FROM ({q})"


LANDED_SQL = f"""
SELECT *, 1 AS seq FROM ({candles_sql(f"WHERE ts < TIMESTAMP '{RUN1_END}'", RUN1_TS)})
UNION ALL
SELECT *, 2 AS seq FROM ({candles_sql(f"WHERE ts >= TIMESTAMP '{RUN2_START}'", RUN2_TS, corrected=True)})
"""

DEDUP_SQL = f"""
SELECT event_time, symbol, timeframe, open, high, low, close, volume, source, ingestion_time
FROM (SELECT *, row_number() OVER (PARTITION BY source, symbol, timeframe, event_time
                                   ORDER BY ingestion_time DESC, seq DESC) AS rn
      FROM ({LANDED_SQL}))
WHERE rn = 1
"""

DAILY_SQL = """
SELECT 'orders' AS source, o_orderpriority AS symbol, '1d' AS timeframe,
       date_trunc('day', o_orderdate) AS event_time,
       arg_min(o_totalprice, (o_orderdate, o_orderkey, o_totalprice)) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, (o_orderdate, o_orderkey, o_totalprice)) AS close,
       sum(o_totalprice) AS volume, max(o_orderdate) AS ingestion_time
FROM orders GROUP BY 1, 2, 3, 4
"""

DIRTY_SQL = """
SELECT event_time, symbol, '1m' AS timeframe, open,
       CASE WHEN event_id % 97 = 0 THEN least(open, close) - 1.0
            WHEN event_id % 71 = 0 THEN 'NaN'::DOUBLE
            ELSE greatest(open, close) + CAST((user_id % 5) * 0.25 AS DOUBLE) END AS high,
       CASE WHEN event_id % 79 = 0 THEN greatest(open, close) + 1.0
            ELSE least(open, close) - CAST((user_id % 3) * 0.25 AS DOUBLE) END AS low,
       close,
       CAST(CASE WHEN event_id % 83 = 0 THEN -1.0 - (user_id % 11) ELSE (user_id % 11) * 1.5 END AS DOUBLE) AS volume,
       'events' AS source, event_time + INTERVAL 1 MINUTE AS ingestion_time
FROM (SELECT event_id, user_id, ts AS event_time,
             CASE WHEN event_id % 67 = 0 THEN NULL ELSE event_type END AS symbol,
             CASE WHEN event_id % 73 = 0 THEN -value ELSE value END AS open,
             CASE WHEN event_id % 89 = 0 THEN NULL ELSE value + CAST(((event_id % 7) - 3) * 0.5 AS DOUBLE) END AS close
      FROM events)
"""

LINE_DAILY_SQL = """
SELECT 'lineitem' AS source, l_returnflag || l_linestatus AS symbol, '1d' AS timeframe,
       date_trunc('day', l_shipdate) AS event_time,
       arg_min(l_extendedprice, (l_shipdate, l_orderkey * 8 + l_linenumber, l_extendedprice)) AS open, max(l_extendedprice) AS high,
       min(l_extendedprice) AS low, arg_max(l_extendedprice, (l_shipdate, l_orderkey * 8 + l_linenumber, l_extendedprice)) AS close,
       sum(l_quantity) AS volume, max(l_shipdate) AS ingestion_time
FROM lineitem GROUP BY 1, 2, 3, 4
"""
