"""Gold kept up to date: a change to a store recomputes its series from the first touched month on.

Beside the gold rows (partitioned by series, year and month) the store keeps
the state of each series after each of its months: about 1.7 KB a month, with
all channels of the gold pass.  An update reads the touched series' candles from
their first touched month on, goes on from the state before it, and replaces
these months' rows and states.  New months at the end cost what they hold; an
old month that is corrected changes everything after it, as the averages have no
end, and nothing before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wickworks.operators.indicators import indicators_from
from wickworks.plans.merge import one_of
from wickworks.schema import GOLD_COLUMNS, SERIES_KEY
from wickworks.session import scratch_path
from wickworks.sources.lake import exists, read_lake, read_table

MONTHS = (*SERIES_KEY, "year", "month")


def month_no(year: Column | str = "year", month: Column | str = "month") -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return c(year) * 12 + c(month) - 1


def first_touched(months: Sequence[Row]) -> dict[int, list[tuple]]:
    """{first touched month: the series it holds for}, from touched (series, year, month) rows."""
    first: dict[tuple, int] = {}
    for m in months:
        key = tuple(m[c] for c in SERIES_KEY)
        first[key] = min(first.get(key, 1 << 30), m["year"] * 12 + m["month"] - 1)
    out: dict[int, list[tuple]] = {}
    for key, n in first.items():
        out.setdefault(n, []).append(key)
    return out


def _from(first: dict[int, list[tuple]], before: bool = False) -> Column:
    """Partition filter: months from the first touched one of their series on, or those before it."""
    parts = [one_of(SERIES_KEY, keys) & ((month_no() < n) if before else (month_no() >= n)) for n, keys in first.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def affected(spark: SparkSession, lake_root: str, months: Sequence[Row]) -> DataFrame:
    """The stored candles whose gold changes when ``months`` have changed."""
    return read_lake(spark, lake_root).where(_from(first_touched(months)))


def read_states(spark: SparkSession, gold_root: str) -> DataFrame:
    """(series, year, month, last_time, state): the state of each series after each month."""
    return read_table(spark, f"{gold_root}/states")


def read_gold(spark: SparkSession, gold_root: str) -> DataFrame:
    return read_table(spark, f"{gold_root}/rows").select(*GOLD_COLUMNS)


def update_gold(spark: SparkSession, lake_root: str, gold_root: str, months: Sequence[Row]) -> None:
    """Bring the gold at ``gold_root`` up to date after ``months`` (of ``merge.merge_months``) of the store have changed.

    ``months`` must hold every month changed since the last update; the first
    update takes all there are.  An update goes on from states before ``months``,
    which it leaves as they are, so one that failed can be run again with the same
    months.  A month that has lost all its rows keeps its old gold."""
    if not months:
        return
    first = first_touched(months)
    known = kept = None
    if exists(spark, f"{gold_root}/states"):
        kept = read_states(spark, gold_root).where(_from(first, before=True))
        known = kept.groupBy(*SERIES_KEY).agg(F.max_by("state", month_no()).alias("state"))
    candles = affected(spark, lake_root, months).select(*[c for c in GOLD_COLUMNS if c not in GOLD_COLUMNS[-6:]])
    rows, ends = indicators_from(candles, known, per_month=True)
    state = F.max_by(F.struct("last_time", "state"), F.struct("_bucket", "_sub"))
    fresh = ends.groupBy(*SERIES_KEY, F.year("last_time").alias("year"), F.month("last_time").alias("month")).agg(state.alias("s"))
    fresh = fresh.select(*MONTHS, "s.*")
    staged = scratch_path(spark, "gold-states")
    (fresh if kept is None else fresh.unionByName(kept)).write.parquet(staged)  # also for series that only have earlier months
    _replace(rows.select(*GOLD_COLUMNS), f"{gold_root}/rows", MONTHS, ["event_time"])
    _replace(spark.read.schema(fresh.schema).parquet(staged), f"{gold_root}/states", SERIES_KEY, ["year", "month"])


def _replace(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str]) -> None:
    (
        df.repartition(*partitions)
        .sortWithinPartitions(*partitions, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
