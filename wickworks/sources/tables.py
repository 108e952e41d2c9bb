"""Driver tables as candle inputs.

The given tables hold no market data, so ticks are read off them:

* ``events``: one tick per event, symbol = event_type, price = size = value,
  tie-break = event_id (timestamps are distinct, the tie-break keeps the choice
  deterministic anyway);
* ``orders``: one tick per order, symbol = o_orderpriority, price = size =
  o_totalprice, tie-break = o_orderkey;
* ``lineitem``: one tick per line, symbol = l_returnflag || l_linestatus,
  price = l_extendedprice, size = l_quantity, tie-break = (l_orderkey, l_linenumber).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit("events").alias("source"),
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.col("value").alias("size"),
        F.col("event_id").alias("seq"),
    )


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.lit("orders").alias("source"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("price"),
        F.col("o_totalprice").alias("size"),
        F.col("o_orderkey").alias("seq"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit("lineitem").alias("source"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("seq"),
    )
