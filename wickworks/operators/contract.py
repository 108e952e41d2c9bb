"""Contract operators: typed frames, validation, violation counts, run statistics.

Validation is one boolean column evaluated row by row (no shuffle); the
counts are one global aggregate with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.functions.numeric import nan_to_null
from wickworks.schema import OHLCV_COLUMNS, OHLCV_SCHEMA, PRICE_COLUMNS, REQUIRED_COLUMNS, TIMEFRAME_MS

# Violation rules in message order, (rule id, message suffix).
VIOLATIONS = [
    ("high_below_body", "records have high < max(open, close)"),
    ("low_above_body", "records have low > min(open, close)"),
    ("high_below_low", "records have high < low"),
    ("negative_volume", "records have negative volume"),
]


def empty_ohlcv(spark: SparkSession) -> DataFrame:
    """Typed empty frame with the ten contract columns."""
    return spark.createDataFrame([], OHLCV_SCHEMA)


def to_contract(df: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Cast to the contract types and order; a missing ingestion_time becomes one run time."""
    cols = []
    for f in OHLCV_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "ingestion_time":
            cols.append((ingestion_time if ingestion_time is not None else F.current_timestamp()).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns absent from the frame (a schema check on the driver)."""
    return [c for c in required if c not in df.columns]


def _clean(c: str) -> Column:
    return nan_to_null(F.col(c)) if c in PRICE_COLUMNS + ["volume"] else F.col(c)


def violation_flags(df: DataFrame) -> dict[str, Column]:
    """Each rule as a boolean column; rows with null operands count as no violation."""
    o, h, lo, c, v = (_clean(x) for x in ("open", "high", "low", "close", "volume"))
    return {
        "high_below_body": F.coalesce(h < F.greatest(o, c), F.lit(False)),
        "low_above_body": F.coalesce(lo > F.least(o, c), F.lit(False)),
        "high_below_low": F.coalesce(h < lo, F.lit(False)),
        "negative_volume": F.coalesce(v < 0, F.lit(False)),
    }


def valid_flag(df: DataFrame, strict: bool = False) -> Column:
    """True when the row passes the batch rules (strict adds prices >= 0 and non-empty text).

    null anywhere in the nine required columns -> invalid; NaN counts as null."""
    no_null = reduce(lambda a, b: a & b, [_clean(c).isNotNull() for c in REQUIRED_COLUMNS])
    o, h, lo, c, v = (_clean(x) for x in ("open", "high", "low", "close", "volume"))
    ok = no_null & (h >= F.greatest(o, c)) & (lo <= F.least(o, c)) & (h >= lo) & (v >= 0)
    if strict:
        ok = ok & reduce(lambda a, b: a & b, [_clean(p) >= 0 for p in PRICE_COLUMNS])
        ok = ok & (F.length("symbol") >= 1) & (F.length("timeframe") >= 1) & F.col("ingestion_time").isNotNull()
    return F.coalesce(ok, F.lit(False))


def validate(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that pass the batch validation (D-1); a frame missing a required column is
    returned unfiltered, as the contract prescribes (D-2)."""
    if missing_columns(df):
        return df
    return df.where(valid_flag(df, strict))


def assert_valid(df: DataFrame, strict: bool = True) -> DataFrame:
    """Raise ``ValueError`` when any row breaks the rules (the row contract's raising
    form, D-3); one aggregate action.  Returns ``df`` unchanged otherwise."""
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"Missing required columns: {set(missing)}")
    bad = df.agg(F.count_if(~valid_flag(df, strict)).alias("n")).first()["n"]
    if bad:
        msgs = [r.message for r in validation_messages(df).orderBy("ord").collect()]
        raise ValueError(f"{bad} rows violate the OHLCV contract: " + "; ".join(msgs))
    return df


def invalid_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """The quarantine side of ``validate`` (D-4)."""
    if missing_columns(df):
        return df.limit(0)
    return df.where(~valid_flag(df, strict))


def violation_counts(df: DataFrame) -> DataFrame:
    """One row: null count per required column and count per violation rule (F1, F2)."""
    aggs = [F.count_if(_clean(c).isNull()).cast("bigint").alias(f"null_{c}") for c in REQUIRED_COLUMNS]
    aggs += [F.count_if(flag).cast("bigint").alias(rule) for rule, flag in violation_flags(df).items()]
    aggs.append(F.count(F.lit(1)).cast("bigint").alias("total"))
    return df.agg(*aggs)


def validation_messages(df: DataFrame) -> DataFrame:
    """The validator's messages as rows (message order kept by ``ord``): missing columns,
    columns with nulls, then one line per violated rule."""
    missing = missing_columns(df)
    spark = df.sparkSession
    if missing:
        return spark.createDataFrame([(0, f"Missing required columns: {set(missing)}")], "ord int, message string")
    counts = violation_counts(df)
    items = [
        F.struct(F.lit(i).alias("ord"), F.col(f"null_{c}").alias("n"),
                 F.concat(F.lit(f"Column '{c}' has "), F.col(f"null_{c}").cast("string"), F.lit(" null values")).alias("message"))
        for i, c in enumerate(REQUIRED_COLUMNS)
    ]
    items += [
        F.struct(F.lit(100 + i).alias("ord"), F.col(rule).alias("n"),
                 F.concat(F.col(rule).cast("string"), F.lit(" " + text)).alias("message"))
        for i, (rule, text) in enumerate(VIOLATIONS)
    ]
    return (
        counts.select(F.explode(F.array(*items)).alias("m"))
        .where(F.col("m.n") > 0)
        .select(F.col("m.ord").alias("ord"), F.col("m.message").alias("message"))
    )


def record_counts(df: DataFrame) -> DataFrame:
    """Records per (symbol, timeframe, source) batch."""
    return df.groupBy("symbol", "timeframe", "source").agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))


def run_stats(df: DataFrame, start: Column | None = None, end: Column | None = None, strict: bool = False) -> DataFrame:
    """Run statistics per (symbol, timeframe): start/end ISO text, total, valid, invalid (F8)."""
    valid = valid_flag(df, strict) if not missing_columns(df) else F.lit(True)
    out = df.groupBy("symbol", "timeframe").agg(
        F.min("event_time").alias("_start"),
        F.max("event_time").alias("_end"),
        F.count(F.lit(1)).cast("bigint").alias("total_records"),
        F.count_if(valid).cast("bigint").alias("valid_records"),
    )
    s = start if start is not None else F.col("_start")
    e = end if end is not None else F.col("_end")
    return out.select(
        "symbol",
        "timeframe",
        F.date_format(s, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("start_date"),
        F.date_format(e, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("end_date"),
        "total_records",
        "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("invalid_records"),
    )


def check_interval(interval: str) -> str:
    """Argument check for an interval code (D-9)."""
    if interval not in TIMEFRAME_MS:
        raise ValueError(f"Invalid interval: {interval}. Must be one of {list(TIMEFRAME_MS)}")
    return interval


def unknown_timeframes(df: DataFrame) -> DataFrame:
    """Rows whose timeframe is not a known interval code (column form of D-9)."""
    known = df.sparkSession.createDataFrame([(k,) for k in TIMEFRAME_MS], "timeframe string")
    return df.join(F.broadcast(known), "timeframe", "left_anti")


def time_range(df: DataFrame, start: str, end: str, col: str = "event_time") -> DataFrame:
    """start (inclusive) .. end date inclusive through 23:59:59.999999 UTC (D-5)."""
    lo = F.to_timestamp(F.lit(start))
    hi = F.date_add(F.to_date(F.lit(end)), 1).cast("timestamp")
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


__all__ = [
    "OHLCV_COLUMNS",
    "assert_valid",
    "check_interval",
    "empty_ohlcv",
    "invalid_rows",
    "missing_columns",
    "record_counts",
    "run_stats",
    "time_range",
    "to_contract",
    "unknown_timeframes",
    "valid_flag",
    "validate",
    "validation_messages",
    "violation_counts",
    "violation_flags",
]
