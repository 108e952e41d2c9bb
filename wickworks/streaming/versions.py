"""State tables of micro-batches, one version under the number of each batch."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wickworks.sources.lake import exists, read_table


def state_before(spark: SparkSession, states: str, n: int) -> DataFrame | None:
    """The state that batch ``n`` goes on from; None for the first batch.

    A missing version raises: to start from nothing would give wrong values
    without a word."""
    if n == 0:
        return None
    path = f"{states}/batch={n - 1}"
    if not exists(spark, path):
        raise FileNotFoundError(f"batch {n} needs the state of batch {n - 1} at {path}: restore it, or start anew with a fresh checkpoint")
    return read_table(spark, path)


def forget_before(spark: SparkSession, states: str, n: int) -> None:
    """Delete the versions of batches before ``n``; the last two are enough to repeat a batch."""
    jvm, root = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(states)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        found = re.fullmatch(r"batch=(\d+)", status.getPath().getName())
        if found and int(found[1]) < n:
            fs.delete(jvm.org.apache.hadoop.fs.Path(status.getPath().toString()), True)
