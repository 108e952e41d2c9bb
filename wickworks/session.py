"""Session helpers.

``local_session`` is for tests and the bench only; on a cluster the caller owns
the session.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session
(the shared folder the cluster names).  Where the setting is missing, a local
master gets a scratch folder and any other master an error: a folder of one
machine is never used on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, AQE re-planning (coalescing,
# skew-join splitting, runtime broadcast choice from measured sizes).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Whole-stage methods above the JVM's 8000-byte JIT limit run as interpreted
    # bytecode; at this limit Spark splits them into JIT-able expression code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows that a Python worker gets at once: whole texts are long, and memory goes with them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wickworks") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Pin the session settings the operators assume (UTC, AQE)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, the folder given to ``setCheckpointDir`` is
    used, else a fresh scratch folder on a local master; any other master
    raises.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="wickworks-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """The path of a fresh sub-folder of the shared folder (made by whoever writes to it)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
