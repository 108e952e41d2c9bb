"""Store round trips: partition layout, keep-last dedup, file cap, empty input."""

import glob
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wickworks.operators.dedup import dedup_last
from wickworks.schema import OHLCV_COLUMNS, OHLCV_SCHEMA
from wickworks.sinks.lake import write_lake
from wickworks.sources.lake import lake_info, read_lake, read_partition

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _fifty(spark):
    rows = [(T0 + timedelta(hours=i % 24), "BTCUSDT", "1h", 42000.0 + i, 42500.0 + i, 41800.0 + i, 42200.0 + i,
             1000.0 + i, "binance", T0, i) for i in range(50)]
    schema = StructType(OHLCV_SCHEMA.fields + [StructField("seq", IntegerType())])
    return spark.createDataFrame(rows, schema)


def test_write_read_dedup(spark, tmp_dir):
    df = dedup_last(_fifty(spark)).drop("seq")
    write_lake(df, tmp_dir, max_rows_per_file=100)
    assert os.path.isdir(os.path.join(tmp_dir, "source=binance/symbol=BTCUSDT/timeframe=1h/year=2024/month=01"))
    back = read_partition(spark, tmp_dir, "binance", "BTCUSDT", "1h", 2024, 1)
    rows = back.collect()
    assert len(rows) == 24 and back.columns == OHLCV_COLUMNS
    opens = {r.event_time.replace(tzinfo=None).hour: r.open for r in rows}
    assert opens[0] == 42048.0 and opens[1] == 42049.0 and opens[2] == 42026.0 and opens[23] == 42047.0
    times = [r.event_time for r in rows]
    assert times == sorted(times)


def test_three_equal_keys(spark):
    rows = [(T0, "BTCUSDT", "1h", 1.0, 2.0, 0.5, 1.5, 10.0, "binance", T0)] * 3
    assert dedup_last(spark.createDataFrame(rows, OHLCV_SCHEMA)).count() == 1


def test_file_cap_and_info(spark, tmp_dir):
    rows = [(T0 + timedelta(hours=i), "X", "1h", 1.0, 2.0, 0.5, 1.5, 10.0, "s", T0) for i in range(250)]
    df = spark.createDataFrame(rows, OHLCV_SCHEMA).where(F.month("event_time") == 1)
    write_lake(df.repartition(1), tmp_dir, max_rows_per_file=100)
    files = glob.glob(os.path.join(tmp_dir, "source=s/symbol=X/timeframe=1h/year=2024/month=01/*.parquet"))
    assert len(files) == 3
    info = lake_info(read_lake(spark, tmp_dir)).collect()[0]
    assert info.total_rows == 250 and info.file_count == 3


def test_partition_pruning_in_plan(spark, tmp_dir):
    write_lake(dedup_last(_fifty(spark)).drop("seq"), tmp_dir)
    plan = read_partition(spark, tmp_dir, "binance", "BTCUSDT", "1h", 2024, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "symbol" in plan


def test_missing_store_is_empty(spark, tmp_dir):
    df = read_partition(spark, os.path.join(tmp_dir, "nope"), "a", "b", "1h")
    assert df.count() == 0 and df.columns == OHLCV_COLUMNS


def test_empty_write_makes_no_files(spark, tmp_dir):
    write_lake(spark.createDataFrame([], OHLCV_SCHEMA), tmp_dir + "/lake")
    assert not glob.glob(os.path.join(tmp_dir, "lake", "source=*"))
