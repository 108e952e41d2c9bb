"""Months of a store that a run touches: reading, merging and replacing only those.

The touched (series, month) pairs are collected: there are as many as the run
has months.  They become a literal predicate over the partition columns, so that
the scan lists and reads the directories of these months alone, however large
the store is.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.dedup import dedup_last
from wickworks.schema import DEFAULT_MAX_ROWS_PER_FILE, OHLCV_COLUMNS, SERIES_KEY
from wickworks.session import scratch_path
from wickworks.sinks.lake import write_lake
from wickworks.sources.lake import lake_files, read_lake

SEPARATOR = "\x01"


@dataclass
class Merged:
    """What a merge has done: the months replaced, their files, and the folder of the staged rows."""

    months: list[Row] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    staged: str | None = None


def touched_months(rows: DataFrame) -> list[Row]:
    """The distinct (source, symbol, timeframe, year, month) of contract rows."""
    return rows.select(*SERIES_KEY, F.year("event_time").alias("year"), F.month("event_time").alias("month")).distinct().collect()


def key_text(*cols: str) -> Column:
    return F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in cols])


def one_of(cols: Sequence[str], rows: Iterable[Sequence]) -> Column:
    """Is (``cols``) one of ``rows``? Over partition columns this is a partition filter."""
    return key_text(*cols).isin([SEPARATOR.join(map(str, r)) for r in rows])


def in_months(df: DataFrame, months: Sequence[Row]) -> DataFrame:
    """The rows of a store's frame that lie in ``months``."""
    return df.where(one_of([*SERIES_KEY, "year", "month"], [(m["source"], m["symbol"], m["timeframe"], m["year"], m["month"]) for m in months]))


def merge_months(spark: SparkSession, root: str, new: DataFrame, max_rows_per_file: int = DEFAULT_MAX_ROWS_PER_FILE) -> Merged:
    """Merge contract rows into the store at ``root``; a row of ``new`` replaces a stored one of its key.

    Of several new rows with one key the last by ingestion_time and ``seq`` (if
    there is one) counts.  ``new`` is read twice: hand over a written table.  The
    merged months are staged in the shared folder and then replaced.  Replacing
    isn't atomic over all months: after a failure in it, ``write_lake`` of the
    staged folder in overwrite mode, or the same merge once more, completes it.
    """
    months = touched_months(new)
    if not months:
        return Merged()
    stored = in_months(read_lake(spark, root), months).select(*OHLCV_COLUMNS)
    both = stored.withColumn("run", F.lit(0)).unionByName(new.withColumn("run", F.lit(1)), allowMissingColumns=True)
    staged = scratch_path(spark, "merged-months")
    merged = dedup_last(both, order=("run", "ingestion_time", "seq")).select(*OHLCV_COLUMNS)
    merged.write.parquet(staged)
    write_lake(spark.read.schema(merged.schema).parquet(staged), root, mode="overwrite", max_rows_per_file=max_rows_per_file, keep_last=False)
    files = [r[0] for r in lake_files(in_months(read_lake(spark, root), months)).collect()]
    return Merged(months, files, staged)
