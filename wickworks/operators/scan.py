"""Ordered scans over long series without gathering a series into one task.

A series (one value of the series key, ordered by ``event_time``) is cut into
*blocks*:

* ``_bucket`` = floor(event time / span); the span is ``block_rows`` candle
  slots of the series' timeframe, so a deduplicated candle series puts at most
  about ``block_rows`` rows into one (key, bucket) partition, however long the
  series is;
* ``_sub`` = row index inside the bucket div ``block_rows`` splits an
  over-full bucket (irregular input) so that no block exceeds ``block_rows``.

Per-row work runs in windows partitioned by (key, bucket[, sub]); the rows are
hash-clustered on (key, bucket) once (``materialize`` writes them as a bucketed
table), which spreads even a single hot series over all tasks.
Each block is summarised by a *state* (a struct) and the states are combined
with an associative ``combine``.  ``exclusive_carries`` computes, for every
block, the combined state of all earlier blocks of its series.  It is a
parallel prefix scan: block states are folded in groups of at most ``fanout``
consecutive elements (an ordered array fold), the group totals are folded at the
next level, and so on up to one group per series; the carries then come back
down by joins.  The depth and first-level fan-in (``FoldPlan``) come from the
bucket span and sub-block count observed while the pass input is written
(``materialize``), so no extra job plans them and every group stays bounded
(``levels_for`` gives a static depth for unmaterialized input).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickworks.functions.time import timeframe_ms
from wickworks.session import scratch_path

PASS_TABLE = "wickworks_scan_"
BLOCK_ROWS = 512
FANOUT = 64
# Rows of a pass table per bucket (one task each) on average, over which it gets more buckets.
ROWS_PER_BUCKET = 4_000_000
# Time range the static depth is planned for; data outside it stays correct,
# the top group just holds more than FANOUT elements.
PLANNED_RANGE_US = 130 * 365 * 86_400 * 1_000_000  # 1970 .. 2100
DEFAULT_TIMEFRAME_MS = 3_600_000
MONTH_US = 31 * 86_400 * 1_000_000  # the longest month

# combine(a, b) -> SQL text of the state struct for "a then b" (a, b are SQL references).
# Written as SQL text so that the fold lambdas are parsed once instead of being
# assembled from hundreds of Column calls.
Combine = Callable[[str, str], str]


def floor_div(c: Column, m: int) -> Column:
    """Floor division of a long column by a positive constant (exact for negatives)."""
    return ((c - F.pmod(c, F.lit(m))) / F.lit(m)).cast("bigint")


def safe_block_rows(alphas: Sequence[float], cap: int = BLOCK_ROWS) -> int:
    """Largest block size whose local EMA scaling factor beta^-(n-1) stays below 1e150."""
    n = cap
    for a in alphas:
        beta = 1.0 - a
        if 0.0 < beta < 1.0:
            n = min(n, int(150.0 / math.log10(1.0 / beta)) + 1)
    return max(n, 2)


def levels_for(min_timeframe_ms: int, block_rows: int, fanout: int = FANOUT) -> int:
    """Fold levels so that the top group of a series holds at most ``fanout`` elements."""
    buckets = max(PLANNED_RANGE_US // (min_timeframe_ms * 1000 * block_rows), 1)
    return max(1, math.ceil(math.log(buckets + 1) / math.log(fanout)))


def bucket_span_us(timeframe_col: str | None, block_rows: int, default_ms: int = DEFAULT_TIMEFRAME_MS) -> Column:
    tf = F.lit(default_ms).cast("bigint") if timeframe_col is None else F.coalesce(
        timeframe_ms(timeframe_col), F.lit(default_ms).cast("bigint")
    )
    return tf * F.lit(1000 * block_rows)


def add_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str | Column],
    time_col: str = "event_time",
    timeframe_col: str | None = "timeframe",
    block_rows: int = BLOCK_ROWS,
    per_month: bool = False,
) -> DataFrame:
    """Adds ``_bucket``, ``_sub`` and ``_kb`` (row index inside the block, from 0).

    ``per_month``: no block reaches over the end of a calendar month, so that the
    state after a block is the state after a month for the last block of each.

    A null series key raises: carries are joined on the key, and a scan that
    restarted in every block would be silently wrong."""
    span = bucket_span_us(timeframe_col, block_rows)
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    if per_month:
        into = micros - F.unix_micros(F.date_trunc("month", F.col(time_col).cast("timestamp")))
        month = F.year(time_col) * 12 + F.month(time_col) - 1
        bucket = month * F.ceil(F.lit(MONTH_US) / span) + F.floor(into / span)
    else:
        bucket = ((micros - F.pmod(micros, span)) / span).cast("bigint")
    no_key = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    error = F.raise_error(F.concat(F.lit("null series key: "), no_key)).cast("bigint")
    df = df.withColumn("_bucket", F.when(no_key.isNotNull(), error).otherwise(bucket))
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order_cols)
    df = df.withColumn("_k", F.row_number().over(w) - 1)
    return df.withColumns({
        "_sub": F.floor(F.col("_k") / F.lit(block_rows)).cast("int"),
        "_kb": F.pmod(F.col("_k"), F.lit(block_rows)).cast("int"),
    }).drop("_k")


def materialize(df: DataFrame, keys: Sequence[str]) -> "tuple[DataFrame, FoldPlan]":
    """Write the blocked rows once, bucketed by (key, bucket), to the shared checkpoint
    folder (``spark.checkpoint.dir``) and continue from that table.

    * both consumers of a pass input (block states and per-row finalisation) read
      the written rows instead of recomputing the upstream plan, and the lineage
      of a multi-pass job is cut (a lost executor recomputes from the files);
    * the bucketed scan reports hash partitioning on (key, bucket), so the block
      windows and the carry join run without another shuffle of the rows.

    There are as many buckets as shuffle partitions; a table of more than
    ``ROWS_PER_BUCKET`` rows a bucket is written once more with as many as it needs.

    Also returns the fold plan for the observed bucket span (max - min + 1 over all
    rows, gathered by ``observe`` during the write, no extra job), which bounds the
    number of blocks per series and so the fold depth."""
    import uuid

    from pyspark.sql import Observation

    spark = df.sparkSession
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        n = spark.sparkContext.defaultParallelism

    def write(rows: DataFrame, buckets: int) -> tuple[str, dict]:
        tag = uuid.uuid4().hex
        obs = Observation(f"span_{tag}")
        (
            rows.repartition(buckets, *keys, "_bucket")
            .observe(obs, F.min("_bucket").alias("lo"), F.max("_bucket").alias("hi"), F.max("_sub").alias("subs"), F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .format("parquet")
            .option("path", scratch_path(spark, "scan"))
            .bucketBy(buckets, *keys, "_bucket")
            .sortBy(*keys, "_bucket", "_sub", "_kb")
            .saveAsTable(f"{PASS_TABLE}{tag}")
        )
        return f"{PASS_TABLE}{tag}", obs.get

    name, m = write(df, n)
    needed = -(-int(m.get("rows") or 0) // ROWS_PER_BUCKET)
    if needed > n:  # too few buckets for that many rows: deal them out once more
        small, (name, m) = name, write(spark.table(name), needed)
        drop_pass(spark, small)
    lo, hi, subs = m.get("lo"), m.get("hi"), m.get("subs")
    span = 1 if lo is None or hi is None else int(hi) - int(lo) + 1
    return spark.table(name), FoldPlan.for_span(span, 1 + int(subs or 0))


def pass_tables(spark: SparkSession) -> set[str]:
    """Names of the pass tables of this session's scans."""
    return {t.name for t in spark.catalog.listTables() if t.name.startswith(PASS_TABLE)}


def drop_pass(spark: SparkSession, name: str) -> None:
    """Drop a pass table and delete its files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE {name}")
    for r in rows:
        p = spark._jvm.org.apache.hadoop.fs.Path(r["data_type"])
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession, keep: Sequence[str] | set[str] = ()) -> int:
    """Drop the pass tables of this session's scans, but for ``keep``, and delete their files; how many there were.

    Call it once the results of the scans are written: frames built on them can't
    be read afterwards."""
    names = pass_tables(spark) - set(keep)
    for name in names:
        drop_pass(spark, name)
    return len(names)


class FoldPlan:
    """Fold depth and first-level fan-in for a scan.

    Elements are (bucket, sub) blocks.  The first level groups ``first`` consecutive
    buckets, so a group holds at most ``first * subs`` blocks; with ``subs`` sub-blocks
    per bucket at most, ``first = fanout // subs`` keeps it near ``fanout``.  Higher
    levels group ``fanout`` groups each, up to one group per series."""

    def __init__(self, levels: int, first: int):
        self.levels, self.first = levels, first

    @staticmethod
    def for_span(span: int, subs: int = 1, fanout: int = FANOUT) -> "FoldPlan":
        first = max(1, fanout // max(subs, 1))
        levels, covered = 1, first
        while covered < span:
            levels += 1
            covered *= fanout
        if levels == 1:
            first = fanout
        return FoldPlan(levels, first)


def block_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, "_bucket", "_sub").orderBy("_kb")


def join_on_renamed(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols``; the right side's copies are renamed first so that sides
    sharing lineage never resolve to the same attribute, then dropped.  Series keys
    are non-null by contract, so plain equality keeps the join keys equal to the
    columns the rows are already hash-partitioned on."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = None
    for c in cols:
        e = F.col(c) == F.col(f"_r_{c}")
        cond = e if cond is None else cond & e
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def _nullable(dt: T.DataType) -> T.DataType:
    """The same type with every struct field, array element and map value nullable."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_nullable(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, _nullable(dt.valueType), True)
    return dt


def _combine_opt(combine: Combine, a: str, b: str, ddl: str) -> str:
    return f"CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} ELSE CAST({combine(a, b)} AS {ddl}) END"


def exclusive_carries(
    elems: DataFrame,
    keys: Sequence[str],
    state_col: str,
    combine: Combine,
    levels: "int | FoldPlan",
    fanout: int = FANOUT,
) -> DataFrame:
    """For each element (keys, ``_bucket``, ``_sub``, state) return the combined state of
    all earlier elements of its series as ``_carry`` (null for the first element).

    ``levels`` is a ``FoldPlan`` (or a plain depth with fan-in ``fanout`` everywhere)."""
    plan = levels if isinstance(levels, FoldPlan) else FoldPlan(levels, fanout)
    levels = plan.levels
    st_type = _nullable(elems.schema[state_col].dataType)
    ddl = st_type.simpleString()
    fold = F.expr(
        f"aggregate(_items, named_struct('tot', CAST(NULL AS {ddl}), 'pre', CAST(array() AS array<{ddl}>)), "
        f"(acc, e) -> named_struct('tot', {_combine_opt(combine, 'acc.tot', 'e._st', ddl)}, "
        f"'pre', concat(acc.pre, array(acc.tot))))"
    )
    zipped = F.expr("transform(_items, (x, i) -> named_struct('it', x, 'pre', _f.pre[i]))")

    cur = elems.select(*keys, "_bucket", "_sub", F.col(state_col).cast(st_type).alias("_st"))
    if levels > 1:  # one row per block, written once: every fold level reads these, not the rows again
        path = scratch_path(cur.sparkSession, "states")
        cur.write.parquet(path)
        cur = cur.sparkSession.read.schema(cur.schema).parquet(path)
    item_cols = ["_bucket", "_sub"]
    base = "_bucket"
    folded = []
    for level in range(1, levels + 1):
        group_cols: list[str] = []
        if level < levels:
            gcol = f"_g{level}"
            cur = cur.withColumn(gcol, floor_div(F.col(base), plan.first if level == 1 else fanout))
            group_cols = [gcol]
        item = F.struct(*[F.col(c) for c in item_cols], F.col("_st"))
        g = cur.groupBy(*keys, *group_cols).agg(F.sort_array(F.collect_list(item)).alias("_items"))
        g = g.withColumn("_f", fold).select(*keys, *group_cols, zipped.alias("_z"), F.col("_f.tot").alias("_tot"))
        folded.append((g, list(item_cols), group_cols))
        if group_cols:
            cur = g.select(*keys, *group_cols, F.col("_tot").alias("_st"))
            item_cols = group_cols
            base = group_cols[0]

    carry_tbl: DataFrame | None = None
    for g, icols, gcols in reversed(folded):
        ex = g.select(*keys, *gcols, F.explode("_z").alias("_z"))
        ex = ex.select(*keys, *gcols, *[F.col("_z.it")[c].alias(c) for c in icols], F.col("_z.pre").alias("_pre"))
        if carry_tbl is None:
            ex = ex.withColumnRenamed("_pre", "_carry")
        else:
            ex = join_on_renamed(ex, carry_tbl, list(keys) + gcols).select(
                *keys, *gcols, *icols, F.expr(_combine_opt(combine, "_gc", "_pre", ddl)).alias("_carry"),
            )
        if icols == ["_bucket", "_sub"]:
            return ex.select(*keys, "_bucket", "_sub", "_carry")
        carry_tbl = ex.select(*keys, *icols, F.col("_carry").alias("_gc"))
    raise AssertionError("unreachable")


def after_initial(carries: DataFrame, initial: DataFrame, keys: Sequence[str], combine: Combine) -> DataFrame:
    """``carries`` of series that go on from a state: ``initial`` holds one row (keys, ``state``) per such series."""
    st_type = carries.schema["_carry"].dataType
    known = initial.select(*keys, F.col("state").cast(st_type).alias("_init"))
    joined = join_on_renamed(carries, known, keys, "left")
    return joined.withColumn("_carry", F.expr(_combine_opt(combine, "_init", "_carry", st_type.simpleString()))).drop("_init")


def block_ends(elems: DataFrame, carries: DataFrame, keys: Sequence[str], combine: Combine) -> DataFrame:
    """(keys, ``_bucket``, ``_sub``, ``last_time``, ``state``): the state of the series after each block."""
    st_type = carries.schema["_carry"].dataType
    both = join_on_renamed(elems.withColumn("_st", F.col("_st").cast(st_type)), carries, [*keys, "_bucket", "_sub"])
    return both.select(*keys, "_bucket", "_sub", "last_time", F.expr(_combine_opt(combine, "_carry", "_st", st_type.simpleString())).alias("state"))


def attach_carries(rows: DataFrame, carries: DataFrame, keys: Sequence[str], finish: Callable[[Column], Column] | None = None) -> DataFrame:
    """Join element carries back to the rows as column ``_c``.

    Carries are packed per (key, bucket) so that the join keys equal the rows'
    existing hash partitioning: the big side is not shuffled again.  ``finish``
    extends each carry, after the shuffle and once per block."""
    packed = carries.groupBy(*keys, "_bucket").agg(
        F.sort_array(F.collect_list(F.struct("_sub", F.col("_carry").alias("c")))).alias("_carr")
    )
    if finish is not None:
        packed = packed.withColumn("_carr", F.transform("_carr", lambda x: F.struct(x["_sub"].alias("_sub"), F.when(x["c"].isNotNull(), finish(x["c"])).alias("c"))))
    out = join_on_renamed(rows, packed, list(keys) + ["_bucket"], "left")
    return out.withColumn("_c", F.element_at(F.col("_carr"), F.col("_sub") + 1)["c"]).drop("_carr")


def series_lag(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    time_col: str = "event_time",
    order_cols: Sequence[str] | None = None,
    timeframe_col: str | None = "timeframe",
    prefix: str = "prev_",
    partition_extra: Sequence[str] = (),
) -> DataFrame:
    """Value of ``cols`` on the previous row of the series (null on the first row).

    Within a block this is ``lag``; the first row of a block takes the last row of
    the earlier blocks through ``exclusive_carries`` with a keep-the-later combine."""
    keys = list(keys) + list(partition_extra)
    order_cols = list(order_cols or [time_col])
    blocked, span = materialize(add_blocks(df, keys, order_cols, time_col, timeframe_col), keys)
    wb = block_window(keys)
    last = F.struct(*[F.col(c) for c in cols])
    for c in cols:
        blocked = blocked.withColumn(f"_lag_{c}", F.lag(c, 1).over(wb))
    elems = blocked.groupBy(*keys, "_bucket", "_sub").agg(F.max_by(last, F.col("_kb")).alias("_last"))
    carries = exclusive_carries(elems, keys, "_last", lambda a, b: b, span)
    joined = attach_carries(blocked, carries, keys)
    out = joined
    for c in cols:
        out = out.withColumn(
            prefix + c, F.when(F.col("_kb") == 0, F.col("_c")[c]).otherwise(F.col(f"_lag_{c}"))
        )
    return out.drop("_bucket", "_sub", "_kb", "_c", *[f"_lag_{c}" for c in cols])


def series_ffill(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    time_col: str = "event_time",
    timeframe_col: str | None = "timeframe",
    prefix: str = "last_",
) -> DataFrame:
    """Last non-null value of ``cols`` up to and including the row (forward fill).

    In-block ``last(ignorenulls)`` window; the blocks' last non-null values are
    combined with a keep-the-later-non-null rule to fill the start of a block."""
    keys = list(keys)
    blocked, span = materialize(add_blocks(df, keys, [time_col], time_col, timeframe_col), keys)
    run = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        blocked = blocked.withColumn(f"_ff_{c}", F.last(c, ignorenulls=True).over(run))
    elems = blocked.groupBy(*keys, "_bucket", "_sub").agg(
        F.struct(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_kb"))).alias(c) for c in cols]).alias("_st")
    )

    def combine(a: str, b: str) -> str:
        return "named_struct(" + ", ".join(f"'{c}', coalesce({b}.{c}, {a}.{c})" for c in cols) + ")"

    carries = exclusive_carries(elems, keys, "_st", combine, span)
    out = attach_carries(blocked, carries, keys)
    for c in cols:
        out = out.withColumn(prefix + c, F.coalesce(F.col(f"_ff_{c}"), F.col("_c")[c]))
    return out.drop("_bucket", "_sub", "_kb", "_c", *[f"_ff_{c}" for c in cols])
