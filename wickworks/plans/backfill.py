"""Backfill job: landed exchange pages -> contract rows -> validation ->
keep-last dedup -> merge with the stored months -> partitioned store, with run
statistics.

The pages are parsed once, into a staged table of flagged rows; the statistics
and the merge both read that table.  The months that the run touches, and only
they, are read from the store, merged and staged before they are replaced
(``plans.merge``): a range inside a month leaves the rest of it alone, and the
staged folder in the result completes a run whose last write failed.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators import contract
from wickworks.plans.merge import Merged, merge_months
from wickworks.schema import OHLCV_COLUMNS
from wickworks.session import scratch_path
from wickworks.sources import klines


def contract_rows(pages: DataFrame, symbol: Column | str, timeframe: str, source: str = "binance",
                  ingestion_time: Column | None = None) -> DataFrame:
    """Pages (with a ``page`` column) -> contract rows with a landing ``seq`` for keep-last ties:
    the page landed last wins, then the kline that stands last in it."""
    contract.check_interval(timeframe)
    rows = klines.explode_pages(pages)
    place = F.struct("landing", "kpos") if "landing" in rows.columns else F.col("kpos")
    return klines.klines_to_ohlcv(rows.withColumn("seq", place), symbol, timeframe, source, ingestion_time)


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(spark: SparkSession, pages_path: str, lake_root: str, symbol: str | None, timeframe: str,
        start: str, end: str, source: str = "binance", page_per_file: bool = True,
        max_rows_per_file: int = 200_000) -> dict:
    """Backfill ``[start, end]`` (end date inclusive) of one timeframe from landed pages.

    ``symbol`` None takes the symbols from the pages' ``symbol=`` folders.  A kline
    of the run replaces a stored one of the same key.  A page that can't be parsed
    counts as one invalid record and in ``unparsed_pages``."""
    began = time.monotonic()
    pages = klines.read_pages(spark, pages_path, page_per_file)
    name = F.col("symbol").cast("string") if symbol is None else F.lit(symbol)
    rows = contract_rows(pages.withColumn("unparsed", F.col("page").isNull()), name, timeframe, source, F.current_timestamp())
    lost = F.col("event_time").isNull()  # no time: in no range, and to be counted
    rows = contract.time_range(rows, start, end).unionByName(rows.where(lost))
    rows = _staged(rows.withColumn("is_valid", contract.valid_flag(rows)).select(*OHLCV_COLUMNS, "seq", "unparsed", "is_valid"), "backfill-rows")
    m = rows.agg(F.count("*").alias("total"), F.count_if("is_valid").alias("valid"), F.count_if("unparsed").alias("unparsed")).first()
    errors = [r["message"] for r in contract.validation_messages(rows.select(*OHLCV_COLUMNS)).orderBy("ord").collect()] if m["total"] else []

    new = rows.where("is_valid").select(*OHLCV_COLUMNS, "seq")
    merged = Merged()
    if m["valid"]:
        merged = merge_months(spark, lake_root, new, max_rows_per_file)
    return {
        "symbol": symbol,
        "timeframe": timeframe,
        "start_date": start,
        "end_date": end,
        "total_records": m["total"],
        "valid_records": m["valid"],
        "invalid_records": m["total"] - m["valid"],
        "unparsed_pages": m["unparsed"],
        "files_written": merged.files,
        "staged": merged.staged,
        "validation_errors": errors,
        "duration_seconds": time.monotonic() - began,
    }
