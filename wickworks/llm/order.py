"""Positions in a global order, without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import shuffle_parts, written

_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """``df`` with the long column ``name``: 1, 2, 3, ... in the given order.

    The rows are dealt out by ranges of the order, sorted where they are and
    written; each then adds what lies in the ranges before its own, of which
    the driver sees one count a range.  Rows equal in ``order`` are told apart
    by their place in the input, so that a large group of them is dealt out too.
    """
    spark, place = df.sparkSession, "_place"
    keys = [*order, F.col("_arrived")]
    rows = df.withColumn("_arrived", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(shuffle_parts(spark), *keys).sortWithinPartitions(*keys).drop("_arrived")
    table = written(rows.withColumn(place, F.monotonically_increasing_id()), f"numbered-{name}")
    part, counts, before = F.shiftright(place, _ROW_BITS), [], 0
    for r in table.groupBy(part.alias("part")).count().orderBy("part").collect():
        counts.append((r["part"], before))
        before += r["count"]
    ahead = F.broadcast(spark.createDataFrame(counts, "_part long, _ahead long"))  # a row for each partition
    found = table.withColumn("_part", part).join(ahead, "_part")
    return found.withColumn(name, F.col("_ahead") + F.col(place).bitwiseAND((1 << _ROW_BITS) - 1) + 1).drop("_part", "_ahead", place)
