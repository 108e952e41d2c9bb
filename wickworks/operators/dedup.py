"""Keep-last deduplication on the contract key (series key, event_time).

The newest version of a candle wins: highest ``ingestion_time``, then the
highest ``seq`` (a landing sequence number, so ties are deterministic), then
the remaining columns.  It is a ``groupBy`` with ``max_by`` — a declarative
aggregate with map-side partial aggregation — so a key repeated a billion
times is reduced before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.schema import SERIES_KEY


def dedup_last(
    df: DataFrame,
    keys: Sequence[str] = (*SERIES_KEY, "event_time"),
    order: Sequence[str] = ("ingestion_time", "seq"),
) -> DataFrame:
    """One row per ``keys``: the row with the greatest (``order``..., other columns)."""
    keys = list(keys)
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    rank = F.struct(*[F.col(c) for c in order + tie])
    row = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max_by(row, rank).alias("_r"))
    return out.select(*[F.col(c) for c in keys], *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def removed_count(before: DataFrame, after: DataFrame) -> int:
    """Rows removed by deduplication (an action: two counts)."""
    return before.count() - after.count()
