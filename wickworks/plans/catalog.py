"""Named queries over the driver's tables, each with its DuckDB oracle SQL.

Every query reads the given tables (or data Spark derives from them) in full.
Results are *presented* the same way on both sides: timestamps without zone,
doubles rounded to 6 decimals, integers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickworks.operators import bitmaps, contract, gaps, quality, signals
from wickworks.operators.candles import cascade, resample, ticks_to_candles, with_vwap
from wickworks.operators.dedup import dedup_last
from wickworks.operators.indicators import Ema, ema, indicators, row_index, sma
from wickworks.plans import inputs
from wickworks.plans.inputs import CANDLES_SQL, DAILY_SQL, DEDUP_SQL, DIRTY_SQL, LINE_DAILY_SQL
from wickworks.schema import OHLCV_COLUMNS, SERIES_KEY, ema_alpha, wilder_alpha
from wickworks.sources import klines
from wickworks.sources.tables import event_ticks

Query = Callable[[SparkSession, str], DataFrame]

# Averages of 2-decimal prices often end exactly in a 5 at the 7th decimal, so two
# engines' last-bit differences would round them apart; a fixed offset far below
# the 6th decimal moves the rounding boundary off such exact decimal ties.
ROUND_BIAS = 2.5e-9
# Order prices are ~1e5: their EMAs are compared at 3 decimals (9-10 significant
# digits), the hourly event prices (~1e2) at 6.
ORDER_DECIMALS = 3


def present(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Timestamps -> timestamp_ntz, doubles rounded to ``decimals``, ints -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + F.lit(ROUND_BIAS * 10.0 ** (6 - decimals)), decimals)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r6(x: str, decimals: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE) + {ROUND_BIAS * 10.0 ** (6 - decimals)!r}, {decimals})"


OHLCV_SELECT = (
    "event_time, symbol, timeframe, "
    + ", ".join(f"{r6(c)} AS {c}" for c in ("open", "high", "low", "close", "volume"))
    + ", source, ingestion_time"
)
KEY_SQL = "source, symbol, timeframe"


def with_year_month(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("event_time")).withColumn("month", F.month("event_time"))


# ----------------------------------------------------------------- gold (SQL side)


def gold_sql(base: str, sma_w=200, ema_p=50, fast=12, slow=26, sig=9, rsi_p=14, extra: str = "") -> str:
    """Indicators by a recursive CTE over row_number (the sequential definition)."""
    ae, af, asl, ag, ar = ema_alpha(ema_p), ema_alpha(fast), ema_alpha(slow), ema_alpha(sig), wilder_alpha(rsi_p)
    return f"""
WITH RECURSIVE
s AS (
  SELECT *, row_number() OVER w - 1 AS idx,
         avg(close) OVER (w ROWS BETWEEN {sma_w - 1} PRECEDING AND CURRENT ROW) AS sma_v
  FROM ({base}) WINDOW w AS (PARTITION BY {KEY_SQL} ORDER BY event_time)
),
r AS (
  SELECT source, symbol, timeframe, idx, close, close AS e, close AS f, close AS sl,
         CAST(0 AS DOUBLE) AS sg, CAST(0 AS DOUBLE) AS ag, CAST(0 AS DOUBLE) AS al
  FROM s WHERE idx = 0
  UNION ALL
  SELECT s.source, s.symbol, s.timeframe, s.idx, s.close,
         {ae!r} * s.close + {1 - ae!r} * r.e,
         {af!r} * s.close + {1 - af!r} * r.f,
         {asl!r} * s.close + {1 - asl!r} * r.sl,
         {ag!r} * (({af!r} * s.close + {1 - af!r} * r.f) - ({asl!r} * s.close + {1 - asl!r} * r.sl)) + {1 - ag!r} * r.sg,
         {ar!r} * greatest(s.close - r.close, 0) + {1 - ar!r} * r.ag,
         {ar!r} * greatest(r.close - s.close, 0) + {1 - ar!r} * r.al
  FROM r JOIN s ON s.source = r.source AND s.symbol = r.symbol AND s.timeframe = r.timeframe AND s.idx = r.idx + 1
),
g AS (
  SELECT s.source, s.symbol, s.timeframe, s.event_time, s.open, s.high, s.low, s.close, s.volume,
         year(s.event_time) AS year, month(s.event_time) AS month, s.idx,
         s.sma_v AS sma_{sma_w}, r.e AS ema_{ema_p},
         CASE WHEN r.idx = 0 THEN NULL WHEN r.al = 0 THEN CAST(100 AS DOUBLE)
              ELSE 100.0 - 100.0 / (1.0 + r.ag / r.al) END AS rsi_{rsi_p},
         r.f - r.sl AS macd, r.sg AS macd_signal, (r.f - r.sl) - r.sg AS macd_hist
  FROM s JOIN r USING (source, symbol, timeframe, idx)
)
{extra}"""


GOLD_COLS = ["source", "symbol", "timeframe", "event_time", "open", "high", "low", "close", "volume", "year", "month",
             "sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist"]


def _sel(cols: list[str], doubles: set[str], decimals: int = 6) -> str:
    return ", ".join(f"{r6(c, decimals)} AS {c}" if c in doubles else c for c in cols)


DOUBLE_COLS = {"open", "high", "low", "close", "volume", "sma_200", "ema_50", "rsi_14", "macd", "macd_signal",
               "macd_hist", "sma_20", "ema_20", "rsi_7", "value", "vwap", "quote_volume", "taker_buy_volume",
               "body_low", "body_high", "body_height", "wick_low", "wick_high", "day_num", "ratio", "prev_close"}


def gold_frame(spark: SparkSession, sf_dir: str, keep_internal: bool = False) -> DataFrame:
    return with_year_month(indicators(inputs.deduped(spark, sf_dir), min_timeframe="1h", keep_internal=keep_internal))


# ----------------------------------------------------------------- queries


def q_candles_1h(spark, sf):
    return present(inputs.candles(spark, sf))


def q_resample_1d(spark, sf):
    return present(resample(inputs.candles(spark, sf), "1d"))


def _pages(spark, sf, corrected: bool = False) -> DataFrame:
    """Exchange-style JSON pages of hourly klines built from the event ticks (12-position arrays with
    quote volume, trade count and taker-buy volume): one page per symbol and day.  ``corrected``:
    with prices rounded to 0.1, as a corrected feed sends them."""
    ticks = event_ticks(spark, sf)
    if corrected:
        ticks = ticks.withColumn("price", F.round("price", 1))
    c = ticks.withColumn("event_time", F.date_trunc("hour", "ts")).groupBy("symbol", "event_time").agg(
        F.min_by("price", F.struct("ts", "seq", "price")).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", F.struct("ts", "seq", "price")).alias("close"),
        F.sum("size").alias("volume"), F.sum(F.col("price") * F.col("size")).alias("quote_volume"),
        F.count(F.lit(1)).alias("trades"),
        F.coalesce(F.sum(F.when(F.col("price") >= 100.0, F.col("size"))), F.lit(0.0)).alias("taker_buy_volume"),
    )
    open_ms = F.unix_millis("event_time")
    k = F.array(
        open_ms.cast("string"), *[F.col(x).cast("string") for x in ("open", "high", "low", "close", "volume")],
        (open_ms + 3_599_999).cast("string"), F.col("quote_volume").cast("string"), F.col("trades").cast("string"),
        F.col("taker_buy_volume").cast("string"), F.lit("0"), F.lit("0"),
    )
    pages = c.groupBy("symbol", F.to_date("event_time").alias("day")).agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(open_ms.alias("t"), k.alias("k")))), lambda x: x["k"])).alias("value")
    )
    return pages


def _damaged_pages(spark, sf) -> DataFrame:
    """The pages as rows of klines, some with a price that is no number, a time that is none, or cut after three fields."""
    rows = klines.explode_pages(_pages(spark, sf).select("symbol", F.from_json("value", klines.PAGE_TYPE).alias("page")))
    hour = F.floor(F.get("k", F.lit(0)).cast("bigint") / 3_600_000)
    at = lambda i, text: F.transform("k", lambda x, j: F.when(j == i, F.lit(text)).otherwise(x))
    bad = F.when(hour % 50 == 7, at(1, "abc")).when(hour % 70 == 9, at(0, "x")).when(hour % 90 == 11, F.slice("k", 1, 3)).otherwise(F.col("k"))
    return rows.withColumn("k", bad)


def _landed_pages(spark, sf) -> str:
    """Write the pages as landed files (one folder per symbol, JSON Lines) and return the root."""
    root = _scratch(spark, "pages")
    _pages(spark, sf).select("symbol", "value").write.mode("overwrite").partitionBy("symbol").text(root)
    return root


def _relanded_pages(spark, sf) -> str:
    """Two landings of all symbols: every page, then the corrected pages from 2024-01-15 on and a damaged one."""
    root = _scratch(spark, "pages")
    first, second = _pages(spark, sf), _pages(spark, sf, corrected=True).where("day >= '2024-01-15'")
    damaged = second.groupBy("symbol").agg(F.substring(F.max("value"), 1, 40).alias("value"))
    for n, pages in ((1, first), (2, second), (3, damaged)):
        pages.select("symbol", "value").write.partitionBy("symbol").text(f"{root}/landed_at={n}")
    return root


def _parsed_klines(spark, sf, extras=False) -> DataFrame:
    pages = klines.read_pages(spark, _landed_pages(spark, sf), page_per_file=False)
    pages = pages.withColumn("symbol", F.regexp_extract("file", r"symbol=([^/]+)/", 1))
    rows = klines.explode_pages(pages)
    return klines.klines_to_ohlcv(rows, F.col("symbol"), "1h", "exchange",
                                  F.to_timestamp(F.lit("2024-03-01 00:00:00")), extras=extras)


def q_kline_parse(spark, sf):
    return present(_parsed_klines(spark, sf).select(*OHLCV_COLUMNS))


def q_kline_dirty(spark, sf):
    """A damaged kline has null fields and fails validation by itself."""
    rows = klines.klines_to_ohlcv(_damaged_pages(spark, sf), F.col("symbol"), "1h", "exchange", F.to_timestamp(F.lit("2024-03-01 00:00:00")))
    return present(rows.withColumn("is_valid", contract.valid_flag(rows)).select(*OHLCV_COLUMNS, "is_valid"))


def q_kline_vwap(spark, sf):
    df = with_vwap(_parsed_klines(spark, sf, extras=True))
    return present(df.select("event_time", "symbol", "quote_volume", "trades", "taker_buy_volume", "vwap"))


def q_fetch_windows(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    req = ev.groupBy(F.col("event_type").alias("symbol")).agg(
        F.unix_millis(F.min(F.date_trunc("day", F.col("ts").cast("timestamp")))).alias("start_ms"),
        F.unix_millis(F.max(F.date_trunc("day", F.col("ts").cast("timestamp")))).alias("end_ms"),
    )
    req = req.withColumn("end_ms", F.col("end_ms") + 86_400_000)
    req = req.withColumn("interval", F.explode(F.array(F.lit("1m"), F.lit("5m"), F.lit("1h"))))
    return present(klines.fetch_windows(req))


def q_fetch_windows_edge(spark, sf):
    """Empty and reversed ranges have no windows; monthly pages step by calendar months."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    first = F.unix_millis(F.min(F.date_trunc("day", F.col("ts").cast("timestamp"))))
    req = ev.groupBy(F.col("event_type").alias("symbol")).agg(first.alias("start_ms"), F.count("*").alias("n"))
    span = F.element_at(F.array(F.lit(0), F.lit(-5), F.lit(1), F.lit(3_600_000)), (F.col("n") % 4 + 1).cast("int"))
    req = req.withColumn("end_ms", F.col("start_ms") + span).withColumn("interval", F.explode(F.array(F.lit("1m"), F.lit("1M"))))
    return present(klines.fetch_windows(req.drop("n"), 10))


def q_valid_rows(spark, sf):
    return present(contract.validate(inputs.dirty(spark, sf)))


def q_invalid_rows(spark, sf):
    return present(contract.invalid_rows(inputs.dirty(spark, sf)))


def q_strict_rows(spark, sf):
    return present(contract.validate(inputs.dirty(spark, sf), strict=True))


def q_missing_column(spark, sf):
    """A frame without a required column is not filtered, and says what is missing (D-2, K4)."""
    rows = inputs.dirty(spark, sf).drop("volume")
    passed = contract.validate(rows).count()
    return present(contract.validation_messages(rows).select("message", F.lit(passed).cast("long").alias("rows")))


def q_strict_dates(spark, sf):
    """Order dates as text, parsed strictly (L5), and the day that ends each."""
    from wickworks.functions.time import parse_date_strict

    text = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return present(text.select("o_orderkey", F.date_add(parse_date_strict("text"), 1).cast("string").alias("next_day")))


def q_violation_counts(spark, sf):
    return present(contract.violation_counts(inputs.dirty(spark, sf)))


def q_validation_messages(spark, sf):
    return present(contract.validation_messages(inputs.dirty(spark, sf)))


def q_run_stats(spark, sf):
    return present(contract.run_stats(inputs.dirty(spark, sf)))


def q_record_counts(spark, sf):
    return present(contract.record_counts(contract.validate(inputs.dirty(spark, sf))))


def q_dedup_last(spark, sf):
    return present(inputs.deduped(spark, sf))


def q_range_filter(spark, sf):
    return present(contract.time_range(inputs.candles(spark, sf), "2024-01-05", "2024-01-12"))


def q_partition_counts(spark, sf):
    df = with_year_month(inputs.candles(spark, sf))
    return present(df.groupBy(*SERIES_KEY, "year", "month").agg(F.count(F.lit(1)).alias("rows")))


def q_distinct_years(spark, sf):
    return present(with_year_month(inputs.daily(spark, sf)).select("year").distinct().orderBy("year"))


def q_row_index(spark, sf):
    df = row_index(inputs.candles(spark, sf))
    return present(df.select(*SERIES_KEY, "event_time", "close", "idx"))


def q_chunk_no(spark, sf):
    df = row_index(inputs.candles(spark, sf))
    return present(df.select(*SERIES_KEY, "event_time", "idx", F.floor(F.col("idx") / 100).cast("bigint").alias("chunk")))


def q_sma_200(spark, sf):
    df = sma(inputs.candles(spark, sf))
    return present(df.select(*SERIES_KEY, "event_time", "close", "sma_200"))


def q_ema_50(spark, sf):
    df = ema(inputs.candles(spark, sf), [Ema("ema_50", "close", ema_alpha(50))])
    return present(df.select(*SERIES_KEY, "event_time", "close", "ema_50"))


def _with_gaps(spark, sf) -> DataFrame:
    """Candles of which every 97th hour of the epoch has no close."""
    hour = F.floor(F.unix_millis("event_time") / 3_600_000)
    return inputs.candles(spark, sf).withColumn("close", F.when(hour % 97 != 0, F.col("close")))


def q_ema_nulls(spark, sf):
    """From a series' first null on the EMA is null, for alpha = 1 too."""
    df = ema(_with_gaps(spark, sf), [Ema("ema_50", "close", ema_alpha(50)), Ema("ema_1", "close", 1.0)])
    return present(df.select(*SERIES_KEY, "event_time", "close", "ema_50", "ema_1"))


def q_macd(spark, sf):
    df = with_year_month(indicators(inputs.candles(spark, sf), min_timeframe="1h"))
    return present(df.select(*SERIES_KEY, "event_time", "macd", "macd_signal", "macd_hist"))


def q_rsi_14(spark, sf):
    df = indicators(inputs.candles(spark, sf), min_timeframe="1h")
    return present(df.select(*SERIES_KEY, "event_time", "close", "rsi_14"))


def q_gold(spark, sf):
    return present(gold_frame(spark, sf).select(*GOLD_COLS))


def q_gold_1m(spark, sf):
    """Minutes and days in one frame: the fold has several levels."""
    ticks = event_ticks(spark, sf)
    df = ticks_to_candles(ticks, "1m").unionByName(ticks_to_candles(ticks, "1d"))
    return present(with_year_month(indicators(df)).select(*GOLD_COLS))


def q_indicator_params(spark, sf):
    df = indicators(inputs.candles(spark, sf), sma_window=20, ema_period=20, macd_fast=5, macd_slow=35,
                    macd_signal=5, rsi_period=7, min_timeframe="1h")
    return present(df.select(*SERIES_KEY, "event_time", "sma_20", "ema_20", "rsi_7", "macd", "macd_signal", "macd_hist"))


def q_daily_gold(spark, sf):
    df = with_year_month(indicators(inputs.daily(spark, sf), min_timeframe="1d"))
    return present(df.select(*GOLD_COLS), ORDER_DECIMALS)


def q_ma_cross(spark, sf):
    g = gold_frame(spark, sf, keep_internal=True)
    df = signals.crosses(g, "ema_50", "sma_200")
    return present(signals.signal_points(df, "close"))


def q_macd_cross(spark, sf):
    g = gold_frame(spark, sf, keep_internal=True)
    df = signals.crosses(g, "macd", "macd_signal")
    return present(signals.signal_points(df, "macd"))


def q_ma_cross_year(spark, sf):
    g = with_year_month(indicators(inputs.daily(spark, sf), min_timeframe="1d"))
    df = signals.crosses(g, "ema_50", "sma_200", per_year=True)
    return present(signals.signal_points(df, "close"))


def q_rsi_zones(spark, sf):
    g = gold_frame(spark, sf)
    z = g.select(*SERIES_KEY, "event_time", "rsi_14", signals.rsi_zone("rsi_14").alias("zone"))
    return present(z.where(F.col("zone").isNotNull()))


def q_candle_geometry(spark, sf):
    df = signals.candle_geometry(inputs.candles(spark, sf))
    return present(df.select(*SERIES_KEY, "event_time", "is_up", "body_low", "body_high", "body_height",
                             "wick_low", "wick_high", "day_num"))


def q_year_feed(spark, sf):
    g = with_year_month(indicators(inputs.daily(spark, sf), min_timeframe="1d"))
    return present(signals.year_feed(g, ["symbol", "event_time", "open", "high", "low", "close", "volume",
                                         "sma_200", "ema_50", "rsi_14", "macd", "macd_signal"]), ORDER_DECIMALS)


def q_top_30(spark, sf):
    g = gold_frame(spark, sf)
    return present(signals.first_rows(g.select(*GOLD_COLS), 30, ("event_time", "symbol")))


def q_missing_candles(spark, sf):
    return present(quality.missing_candles(inputs.candles(spark, sf)))


def q_gap_fill(spark, sf):
    return present(quality.gap_fill(inputs.candles(spark, sf)).drop("ingestion_time"))


def _dirty_grid(spark, sf) -> DataFrame:
    """Candles with times off the grid, missing closes, and one symbol under an unknown timeframe code."""
    hour = F.floor(F.unix_millis("event_time") / 3_600_000)
    return inputs.candles(spark, sf).withColumns({
        "event_time": F.when(hour % 5 == 0, F.col("event_time") + F.expr("INTERVAL 61 SECONDS")).otherwise(F.col("event_time")),
        "close": F.when(hour % 7 != 0, F.col("close")),
        "timeframe": F.when(F.col("symbol") == "click", "1s").otherwise(F.col("timeframe")),
    })


def q_missing_candles_dirty(spark, sf):
    return present(quality.missing_candles(_dirty_grid(spark, sf)))


def q_gap_fill_dirty(spark, sf):
    return present(quality.gap_fill(_dirty_grid(spark, sf)).drop("ingestion_time"))


def q_gap_ranges(spark, sf):
    return present(gaps.gap_ranges(inputs.candles(spark, sf)))


def q_gap_ranges_dirty(spark, sf):
    """Candles off the grid fill their slots; days of orders have long gaps; an unknown timeframe is reported."""
    return present(gaps.gap_ranges(_dirty_grid(spark, sf).unionByName(inputs.daily(spark, sf))))


def q_candle_runs(spark, sf):
    return present(gaps.candle_runs(inputs.candles(spark, sf).unionByName(inputs.daily(spark, sf))))


def q_repair_windows(spark, sf):
    return present(gaps.repair_windows(inputs.candles(spark, sf), limit=2))


def q_completeness_bitmap(spark, sf):
    """``completeness`` from slot bitmaps of two loads that overlap in time."""
    candles = inputs.candles(spark, sf)
    loads = [candles.where(F.col("event_time") < F.lit("2024-01-12").cast("timestamp")), candles.where(F.col("event_time") >= F.lit("2024-01-12").cast("timestamp"))]
    return present(bitmaps.completeness_of(bitmaps.merge_bitmaps(*[bitmaps.slot_bitmaps(x) for x in loads])))


def q_missing_by_month(spark, sf):
    return present(bitmaps.months_of(bitmaps.slot_bitmaps(inputs.daily(spark, sf).unionByName(inputs.candles(spark, sf)))))


def q_candle_cascade(spark, sf):
    """Minutes to five minutes to hours to days, each from the next finer ones."""
    minutes = ticks_to_candles(event_ticks(spark, sf), "1m")
    return present(cascade(minutes, ("5m", "1h", "1d")))


def q_resample_mixed(spark, sf):
    """A store that holds 1h and 4h candles of the same trades: days are made of the hours alone."""
    hours = inputs.candles(spark, sf)
    return present(resample(hours.unionByName(resample(hours, "4h")), "1d"))


def q_completeness(spark, sf):
    return present(quality.completeness(inputs.candles(spark, sf)))


def q_unknown_timeframes(spark, sf):
    d = inputs.dirty(spark, sf).withColumn(
        "timeframe", F.element_at(F.array(F.lit("1m"), F.lit("1M"), F.lit("2m"), F.lit("1h"), F.lit("7d")),
                                  (F.hour("event_time") % 5 + 1).cast("int"))
    )
    return present(contract.unknown_timeframes(d).select("event_time", "symbol", "timeframe"))


# ----------------------------------------------------------------- storage round trips


def _scratch(spark, name):
    from wickworks.session import scratch_path

    return scratch_path(spark, name)


def _lake_of_candles(spark, sf) -> str:
    from wickworks.sinks.lake import write_lake

    root = _scratch(spark, "lake")
    write_lake(inputs.candles(spark, sf), root, mode="overwrite", max_rows_per_file=500)
    return root


def q_parquet_roundtrip(spark, sf):
    from wickworks.sources.lake import read_lake

    root = _lake_of_candles(spark, sf)
    return present(read_lake(spark, root).select(*OHLCV_COLUMNS))


def q_partition_read(spark, sf):
    from wickworks.sources.lake import read_partition

    root = _lake_of_candles(spark, sf)
    return present(read_partition(spark, root, "events", "click", "1h", year=2024, month=1))


def q_lake_info(spark, sf):
    from wickworks.sources.lake import lake_info, read_lake

    root = _lake_of_candles(spark, sf)
    return present(lake_info(read_lake(spark, root)).drop("file_count"))


def q_lake_info_files(spark, sf):
    """Store statistics with the number of files (500 rows at most in each)."""
    from wickworks.sources.lake import lake_info, read_lake

    return present(lake_info(read_lake(spark, _lake_of_candles(spark, sf))))


def q_typed_frame(spark, sf):
    """Candles that come as text, without ingestion time: contract types and order (C2), stamped with the run's UTC time."""
    text = inputs.candles(spark, sf).drop("ingestion_time")
    text = text.select("volume", *[F.col(c).cast("string").alias(c) for c in text.columns if c != "volume"], F.lit(1).alias("extra"))
    typed = contract.to_contract(text)
    names = F.lit(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in typed.schema.fields))
    near = F.abs(F.unix_seconds("ingestion_time") - F.unix_seconds(F.current_timestamp())) < 86_400
    return present(typed.select("event_time", "symbol", "open", "high", "low", "close", "volume", names.alias("types"), near.alias("stamped")))


def q_empty_input(spark, sf):
    """No row in, no row out, with the columns that rows would have (D-11)."""
    none = inputs.candles(spark, sf).where(F.col("event_time") < F.lit("1900-01-01").cast("timestamp"))
    frames = {
        "validate": contract.validate(none), "dedup_last": dedup_last(none), "indicators": indicators(none), "resample": resample(none, "1d"),
        "missing_candles": quality.missing_candles(none), "gap_fill": quality.gap_fill(none), "gap_ranges": gaps.gap_ranges(none),
        "slot_bitmaps": bitmaps.slot_bitmaps(none), "candle_geometry": signals.candle_geometry(none),
    }
    rows = [(k, f.count(), len(f.columns)) for k, f in frames.items()]
    return spark.createDataFrame(rows, "operator string, rows long, columns long")


def q_lake_files(spark, sf):
    """Data files by partition directory (files hold 500 rows at most)."""
    from wickworks.sources.lake import lake_files, read_lake

    root = _lake_of_candles(spark, sf)
    folder = F.regexp_extract("file_path", r"(source=.*)/[^/]*$", 1)
    return present(lake_files(read_lake(spark, root)).groupBy(folder.alias("folder")).agg(F.count("*").alias("files")))


def q_write_dedup(spark, sf):
    """Overlapping runs written at once, the writer keeping the last of each key."""
    from wickworks.sinks.lake import write_lake
    from wickworks.sources.lake import read_lake

    root = _scratch(spark, "dedup-lake")
    write_lake(inputs.landed(spark, sf), root, mode="overwrite", keep_last=True)
    return present(read_lake(spark, root).select(*OHLCV_COLUMNS))


def q_utc_write(spark, sf):
    """Times that come as text with an offset are stored as UTC."""
    from wickworks.sinks.lake import write_lake
    from wickworks.sources.lake import read_lake

    root = _scratch(spark, "utc-lake")
    c = inputs.candles(spark, sf)
    local = F.concat(F.date_format(F.col("event_time") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    write_lake(c.withColumn("event_time", local), root, mode="overwrite")
    return present(read_lake(spark, root).select(*OHLCV_COLUMNS))


def q_write_bad_time(spark, sf):
    """Rows whose time is no time are set apart as they came; the others are stored."""
    from wickworks.sinks.lake import write_lake
    from wickworks.sources.lake import read_lake

    root, apart = _scratch(spark, "bad-time-lake"), _scratch(spark, "bad-time-rows")
    hour = F.floor(F.unix_millis("event_time") / 3_600_000)
    text = F.when(hour % 20 == 3, F.lit("garbage")).otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    write_lake(inputs.candles(spark, sf).withColumn("event_time", text), root, mode="overwrite", bad_times=apart)
    rows = read_lake(spark, root).select("symbol", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("time"), "close")
    return present(rows.unionByName(spark.read.parquet(apart).select("symbol", F.col("event_time").alias("time"), "close")))


def q_csv_roundtrip(spark, sf):
    from wickworks.plans.medallion import bronze_to_silver
    from wickworks.sinks.lake import write_csv_partitioned
    from wickworks.sources.lake import read_bronze_csv

    root = _scratch(spark, "bronze")
    write_csv_partitioned(inputs.candles(spark, sf), root)
    silver = bronze_to_silver(read_bronze_csv(spark, root))
    return present(silver.drop("year", "month"))


def q_json_records(spark, sf):
    from wickworks.schema import OHLCV_SCHEMA
    from wickworks.sinks.lake import JSON_TS_FORMAT, json_records

    js = json_records(inputs.candles(spark, sf))
    back = js.select(F.from_json("json", OHLCV_SCHEMA, {"timestampFormat": JSON_TS_FORMAT}).alias("r")).select("r.*")
    return present(back)


def q_medallion_gold(spark, sf):
    from wickworks.plans import medallion
    from wickworks.sinks.lake import write_csv_partitioned

    bronze = _scratch(spark, "bronze")
    write_csv_partitioned(inputs.candles(spark, sf), bronze)
    gold = medallion.run(spark, bronze, _scratch(spark, "silver"), _scratch(spark, "gold"), min_timeframe="1h")
    return present(gold.select(*GOLD_COLS))


# ----------------------------------------------------------------- streaming


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return ev.select(
        F.lit("events").alias("source"), F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"), F.col("value").alias("size"), F.col("event_id").alias("seq"),
    )


def _run_stream(spark, stream, name):
    from wickworks.streaming.candles import read_sink, run_to_parquet

    out = _scratch(spark, f"{name}-out")
    run_to_parquet(stream, out, _scratch(spark, f"{name}-ckpt"))
    return read_sink(spark, out)


def q_stream_candles(spark, sf):
    from wickworks.streaming.candles import stream_candles

    return present(_run_stream(spark, stream_candles(_event_stream(spark, sf)), "stream-candles"))


def q_stream_dedup(spark, sf):
    from wickworks.streaming.candles import stream_dedup

    rows = _event_stream(spark, sf).select("symbol", F.date_trunc("minute", "ts").alias("event_time"), "price")
    out = _run_stream(spark, stream_dedup(rows, ["symbol", "event_time"]), "stream-dedup")
    return present(out.select("symbol", "event_time"))


def _stream_ema_50(spark, candles) -> DataFrame:
    from wickworks.streaming.candles import read_ema, run_ema

    landed, out = _scratch(spark, "stream-candles-in"), _scratch(spark, "stream-ema-out")
    candles.write.parquet(landed)
    stream = spark.readStream.schema(candles.schema).parquet(landed)
    run_ema(stream, out, _scratch(spark, "stream-ema-ckpt"), ema_alpha(50), "ema_50")
    return present(read_ema(spark, out))


def q_stream_ema(spark, sf):
    return _stream_ema_50(spark, inputs.candles(spark, sf))


def q_stream_ema_nulls(spark, sf):
    """The stream's EMA of closes with nulls equals the batch one."""
    return _stream_ema_50(spark, _with_gaps(spark, sf))


def _slices(candles: DataFrame, cuts: list[str]) -> list[DataFrame]:
    """The candles before the first time of ``cuts``, between it and the next, ..., and from the last on."""
    t = F.col("event_time")
    at = [F.lit(c).cast("timestamp") for c in cuts]
    return [candles.where(t < at[0]), *[candles.where((t >= a) & (t < b)) for a, b in zip(at, at[1:])], candles.where(t >= at[-1])]


def q_stream_gold(spark, sf):
    """All gold indicators over four micro-batches; each run goes on from the states of the one before."""
    from wickworks.streaming.carried import read_gold_stream, run_gold

    candles = inputs.deduped(spark, sf)
    landed, out, checkpoint = (_scratch(spark, f"stream-gold-{x}") for x in ("in", "out", "ckpt"))
    for part in _slices(candles, ["2024-01-04", "2024-01-09 12:00", "2024-01-22"]):
        part.write.mode("append").parquet(landed)
        run_gold(spark.readStream.schema(candles.schema).parquet(landed), out, checkpoint)
    return present(with_year_month(read_gold_stream(spark, out)).select(*GOLD_COLS))


def q_stream_gold_late(spark, sf):
    """Rows per series that came after the series had gone on past them, by run: nothing is lost unseen."""
    from wickworks.streaming.carried import read_late_candles, run_gold

    candles = inputs.candles(spark, sf)
    landed, out, checkpoint = (_scratch(spark, f"stream-late-{x}") for x in ("in", "out", "ckpt"))
    first, second, third = _slices(candles, ["2024-01-04", "2024-01-20"])
    for part in (first, third, second):
        part.write.mode("append").parquet(landed)
        run_gold(spark.readStream.schema(candles.schema).parquet(landed), out, checkpoint, sma_window=20, ema_period=20)
    return present(read_late_candles(spark, out))


def q_gold_incremental(spark, sf):
    """A store that grows by two appends, the second of which corrects months of the first: gold is updated
    from the first touched month on each time."""
    from wickworks.plans.incremental import read_gold, update_gold
    from wickworks.plans.merge import merge_months

    lake, gold = _scratch(spark, "incremental-lake"), _scratch(spark, "incremental-gold")
    daily, t = inputs.daily(spark, sf), F.col("event_time")
    wrong = daily.where((t >= "1997-06-01") & (t < "1999-01-01")).withColumn("close", F.when(t >= "1998-03-10", F.col("open")).otherwise(F.col("close")))
    for rows in (daily.where(t < "1997-06-15"), wrong, daily.where(t >= "1998-03-01")):
        staged = _scratch(spark, "incremental-run")
        rows.write.parquet(staged)
        update_gold(spark, lake, gold, merge_months(spark, lake, spark.read.schema(rows.schema).parquet(staged)).months)
    return present(read_gold(spark, gold).select(*GOLD_COLS), ORDER_DECIMALS)


HEARTBEAT = "heartbeat"


def q_stream_keep_last(spark, sf):
    """Two ingestion runs of one stream: the last version of each candle, as the batch store keeps it.

    A heartbeat row of a later time moves the watermark past the last candle."""
    from wickworks.streaming.candles import read_sink, run_to_parquet, stream_keep_last

    rows = inputs.landed(spark, sf)
    landed, out = _scratch(spark, "stream-landed"), _scratch(spark, "stream-last")
    late = F.expr("make_interval(0, 0, 0, 2)")
    beat = rows.agg((F.max("event_time") + late).alias("event_time")).withColumn("symbol", F.lit(HEARTBEAT))
    beat = beat.withColumns({"source": F.lit(HEARTBEAT), "timeframe": F.lit("1h")})
    rows.write.parquet(landed)
    beat.select(*[F.col(f.name).cast(f.dataType) if f.name in beat.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]).write.mode("append").parquet(landed)
    run_to_parquet(stream_keep_last(spark.readStream.schema(rows.schema).parquet(landed)), out, _scratch(spark, "stream-last-ckpt"))
    return present(read_sink(spark, out).where(F.col("source") != HEARTBEAT).select(*OHLCV_COLUMNS))


def q_stream_candles_upsert(spark, sf):
    """Ticks in three deliveries, the second with ticks of candles that the first had: every candle of the whole."""
    from wickworks.streaming.upsert import read_candles, run_candles

    ticks = event_ticks(spark, sf)
    landed, out, checkpoint = (_scratch(spark, f"upsert-{x}") for x in ("in", "out", "ckpt"))
    for part in (F.col("seq") % 3 == 0, F.col("seq") % 3 == 2, F.col("seq") % 3 == 1):
        ticks.where(part).write.mode("append").parquet(landed)
        run_candles(spark.readStream.schema(ticks.schema).parquet(landed), out, checkpoint, "1h", compact_every=2)
    return present(read_candles(spark, out))


def q_backfill(spark, sf):
    """Landed pages of one symbol -> backfill job -> store, read back (2024-01-03 .. 2024-01-20)."""
    from wickworks.plans import backfill
    from wickworks.sources.lake import read_lake

    pages = _landed_pages(spark, sf) + "/symbol=click"
    lake = _scratch(spark, "backfill-lake")
    backfill.run(spark, pages, lake, "click", "1h", "2024-01-03", "2024-01-20", source="exchange", page_per_file=False)
    return present(read_lake(spark, lake).select(*[c for c in OHLCV_COLUMNS if c != "ingestion_time"]))


BACKFILL_COLS = [c for c in OHLCV_COLUMNS if c != "ingestion_time"]


def q_backfill_reland(spark, sf):
    """All symbols from two landings in one run: a kline landed again replaces the one landed before."""
    from wickworks.plans import backfill
    from wickworks.sources.lake import read_lake

    lake = _scratch(spark, "reland-lake")
    backfill.run(spark, _relanded_pages(spark, sf), lake, None, "1h", "2024-01-01", "2024-12-31", source="exchange", page_per_file=False)
    return present(read_lake(spark, lake).select(*BACKFILL_COLS))


def q_backfill_merge(spark, sf):
    """A whole range, then a corrected run over two days of it: the rest of the month stays."""
    from wickworks.plans import backfill
    from wickworks.sources.lake import read_lake

    lake, again = _scratch(spark, "merge-lake"), _scratch(spark, "pages")
    _pages(spark, sf, corrected=True).select("symbol", "value").write.partitionBy("symbol").text(again)
    backfill.run(spark, _landed_pages(spark, sf), lake, None, "1h", "2024-01-01", "2024-12-31", source="exchange", page_per_file=False)
    backfill.run(spark, again, lake, None, "1h", "2024-01-10", "2024-01-11", source="exchange", page_per_file=False)
    return present(read_lake(spark, lake).select(*BACKFILL_COLS))


def q_backfill_stats(spark, sf):
    """The run's statistics; the damaged page of each symbol is counted, not lost."""
    from wickworks.plans import backfill

    stats = backfill.run(spark, _relanded_pages(spark, sf), _scratch(spark, "stats-lake"), None, "1h", "2024-01-01", "2024-12-31",
                         source="exchange", page_per_file=False, max_rows_per_file=500)
    row = (*(stats[c] for c in ("total_records", "valid_records", "invalid_records", "unparsed_pages")), len(stats["files_written"]), stats["validation_errors"][0])
    return spark.createDataFrame([row], "total_records long, valid_records long, invalid_records long, unparsed_pages long, files long, first_error string")


def q_multi_timeframe(spark, sf):
    """One frame over several timeframes (1h, 4h, 1d) from one scan, with per-series counts."""
    allc = resample(inputs.candles(spark, sf), ("1h", "4h", "1d"))
    return present(allc.groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("candles"), F.sum("volume").alias("volume")))


def q_line_candles(spark, sf):
    """Daily candles of every lineitem line (the largest driver table)."""
    return present(inputs.line_daily(spark, sf), ORDER_DECIMALS)


def q_line_gold(spark, sf):
    df = with_year_month(indicators(inputs.line_daily(spark, sf), min_timeframe="1d"))
    return present(df.select(*GOLD_COLS), ORDER_DECIMALS)


def q_append_merge(spark, sf):
    """Two ingestion runs appended to one store (B3), merged by keep-last on read."""
    from wickworks.sinks.lake import write_lake
    from wickworks.sources.lake import read_lake

    root = _scratch(spark, "append-lake")
    landed = inputs.landed(spark, sf)
    for run in (1, 2):
        write_lake(landed.where(F.col("seq") == run), root, mode="append")
    merged = dedup_last(read_lake(spark, root).select(*OHLCV_COLUMNS), order=("ingestion_time",))
    return present(merged)


QUERIES: dict[str, Query] = {
    "candles_1h": q_candles_1h,
    "resample_1d": q_resample_1d,
    "kline_parse": q_kline_parse,
    "kline_vwap": q_kline_vwap,
    "fetch_windows": q_fetch_windows,
    "fetch_windows_edge": q_fetch_windows_edge,
    "valid_rows": q_valid_rows,
    "invalid_rows": q_invalid_rows,
    "strict_rows": q_strict_rows,
    "missing_column": q_missing_column,
    "strict_dates": q_strict_dates,
    "violation_counts": q_violation_counts,
    "validation_messages": q_validation_messages,
    "run_stats": q_run_stats,
    "record_counts": q_record_counts,
    "unknown_timeframes": q_unknown_timeframes,
    "dedup_last": q_dedup_last,
    "range_filter": q_range_filter,
    "partition_counts": q_partition_counts,
    "distinct_years": q_distinct_years,
    "row_index": q_row_index,
    "chunk_no": q_chunk_no,
    "sma_200": q_sma_200,
    "ema_50": q_ema_50,
    "ema_nulls": q_ema_nulls,
    "macd": q_macd,
    "rsi_14": q_rsi_14,
    "gold": q_gold,
    "gold_1m": q_gold_1m,
    "indicator_params": q_indicator_params,
    "daily_gold": q_daily_gold,
    "ma_cross": q_ma_cross,
    "macd_cross": q_macd_cross,
    "ma_cross_year": q_ma_cross_year,
    "rsi_zones": q_rsi_zones,
    "candle_geometry": q_candle_geometry,
    "year_feed": q_year_feed,
    "top_30": q_top_30,
    "missing_candles": q_missing_candles,
    "gap_fill": q_gap_fill,
    "missing_candles_dirty": q_missing_candles_dirty,
    "gap_fill_dirty": q_gap_fill_dirty,
    "resample_mixed": q_resample_mixed,
    "completeness": q_completeness,
    "parquet_roundtrip": q_parquet_roundtrip,
    "partition_read": q_partition_read,
    "lake_info": q_lake_info,
    "lake_files": q_lake_files,
    "write_dedup": q_write_dedup,
    "utc_write": q_utc_write,
    "csv_roundtrip": q_csv_roundtrip,
    "json_records": q_json_records,
    "medallion_gold": q_medallion_gold,
    "stream_candles": q_stream_candles,
    "stream_dedup": q_stream_dedup,
    "stream_ema": q_stream_ema,
    "backfill": q_backfill,
    "backfill_reland": q_backfill_reland,
    "backfill_merge": q_backfill_merge,
    "backfill_stats": q_backfill_stats,
    "stream_ema_nulls": q_stream_ema_nulls,
    "stream_gold": q_stream_gold,
    "lake_info_files": q_lake_info_files,
    "typed_frame": q_typed_frame,
    "empty_input": q_empty_input,
    "kline_dirty": q_kline_dirty,
    "gap_ranges": q_gap_ranges,
    "gap_ranges_dirty": q_gap_ranges_dirty,
    "candle_runs": q_candle_runs,
    "repair_windows": q_repair_windows,
    "completeness_bitmap": q_completeness_bitmap,
    "missing_by_month": q_missing_by_month,
    "candle_cascade": q_candle_cascade,
    "write_bad_time": q_write_bad_time,
    "stream_gold_late": q_stream_gold_late,
    "gold_incremental": q_gold_incremental,
    "stream_keep_last": q_stream_keep_last,
    "stream_candles_upsert": q_stream_candles_upsert,
    "multi_timeframe": q_multi_timeframe,
    "line_candles": q_line_candles,
    "line_gold": q_line_gold,
    "append_merge": q_append_merge,
}


# ----------------------------------------------------------------- oracle SQL

_VALID = """(symbol IS NOT NULL AND timeframe IS NOT NULL AND source IS NOT NULL AND event_time IS NOT NULL
  AND o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL AND v IS NOT NULL
  AND h >= greatest(o, c) AND l <= least(o, c) AND h >= l AND v >= 0)"""

_STRICT = _VALID[:-1] + " AND o >= 0 AND h >= 0 AND l >= 0 AND c >= 0 AND length(symbol) >= 1 AND length(timeframe) >= 1 AND ingestion_time IS NOT NULL)"

_CLEAN = f"""SELECT *, CASE WHEN isnan(open) THEN NULL ELSE open END AS o, CASE WHEN isnan(high) THEN NULL ELSE high END AS h,
  CASE WHEN isnan(low) THEN NULL ELSE low END AS l, CASE WHEN isnan(close) THEN NULL ELSE close END AS c,
  CASE WHEN isnan(volume) THEN NULL ELSE volume END AS v FROM ({DIRTY_SQL})"""


def _gold_from(base: str, cols: str, where: str = "", order: str = "") -> str:
    return gold_sql(base, extra=f"SELECT {cols} FROM g {where} {order}")


GOLD_SELECT = _sel(GOLD_COLS, DOUBLE_COLS)

_LAGGED = """, lag(ema_50) OVER w AS p_e, lag(sma_200) OVER w AS p_s, lag(macd) OVER w AS p_m, lag(macd_signal) OVER w AS p_g
  FROM g WINDOW w AS (PARTITION BY source, symbol, timeframe ORDER BY event_time)"""

_ALL = CANDLES_SQL.format(where="", price="value")
_CORRECTED = CANDLES_SQL.format(where="", price="round(value, 1)")
_BACKFILL_SELECT = f"event_time, symbol, timeframe, {', '.join(f'{r6(c)} AS {c}' for c in ('open', 'high', 'low', 'close', 'volume'))}, 'exchange' AS source"
_GAPPY = f"SELECT * REPLACE (CASE WHEN CAST(floor(epoch_ms(event_time) / 3600000) AS BIGINT) % 97 <> 0 THEN close END AS close) FROM ({_ALL})"
_STICKY = "coalesce(max(CASE WHEN close IS NULL THEN 1 END) OVER (PARTITION BY source, symbol, timeframe ORDER BY event_time), 0) = 1"
# the EMA up to the first null, by the recursive definition over a close that stands in for it afterwards
_EMA_NULLS = f"""SELECT g.*, q.close AS real_close, q.gone FROM g JOIN
    (SELECT source, symbol, timeframe, event_time, close, {_STICKY} AS gone FROM ({_GAPPY})) q USING (source, symbol, timeframe, event_time)"""
_DIRTY_GRID = f"""SELECT * REPLACE (
    CASE WHEN hr % 5 = 0 THEN event_time + INTERVAL 61 SECOND ELSE event_time END AS event_time,
    CASE WHEN hr % 7 <> 0 THEN close END AS close, CASE WHEN symbol = 'click' THEN '1s' ELSE timeframe END AS timeframe)
    FROM (SELECT *, CAST(floor(epoch_ms(event_time) / 3600000) AS BIGINT) AS hr FROM ({_ALL}))"""
_DIRTY_MISSING = """SELECT source, symbol, timeframe, make_timestamp(slot * 3600000000) AS event_time FROM (
      SELECT source, symbol, timeframe, unnest(generate_series(min(hr), max(hr))) AS slot FROM c WHERE timeframe = '1h' GROUP BY 1, 2, 3)
    ANTI JOIN (SELECT source, symbol, timeframe, hr AS slot FROM c) USING (source, symbol, timeframe, slot)"""

# hourly and daily slots of candles, with the slot of the candle before
_SLOTTED = """SELECT *, lag(slot) OVER (PARTITION BY source, symbol, timeframe ORDER BY slot) AS p FROM (
    SELECT DISTINCT source, symbol, timeframe, CAST(floor(epoch_ms(event_time) / unit) AS BIGINT) AS slot, unit
    FROM (SELECT *, CASE timeframe WHEN '1h' THEN 3600000 WHEN '1d' THEN 86400000 END AS unit FROM ({rows})) WHERE unit IS NOT NULL)"""
_GAPS = """SELECT source, symbol, timeframe, make_timestamp((p + 1) * unit * 1000) AS gap_start,
    make_timestamp((slot - 1) * unit * 1000) AS gap_end, slot - p - 1 AS n_missing FROM ({slots}) WHERE slot > p + 1"""
_TWO = f"SELECT * FROM ({_ALL}) UNION ALL BY NAME SELECT * FROM ({DAILY_SQL})"


def _coarse_sql(tf: str, start: str) -> str:
    return f"""SELECT {start} AS event_time, event_type AS symbol, '{tf}' AS timeframe,
        {r6('arg_min(value, (ts, event_id, value))')} AS open, {r6('max(value)')} AS high, {r6('min(value)')} AS low,
        {r6('arg_max(value, (ts, event_id, value))')} AS close, {r6('sum(value)')} AS volume, 'events' AS source, max(ts) AS ingestion_time
        FROM events GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "lake_info_files": f"""SELECT source, symbol, timeframe, CAST(sum(n) AS BIGINT) AS total_rows, min(lo) AS first_event, max(hi) AS last_event,
        CAST(sum(ceil(n / 500)) AS BIGINT) AS file_count
        FROM (SELECT source, symbol, timeframe, count(*) AS n, min(event_time) AS lo, max(event_time) AS hi FROM ({_ALL})
              GROUP BY source, symbol, timeframe, year(event_time), month(event_time)) GROUP BY ALL""",
    "typed_frame": f"""SELECT event_time, symbol, {', '.join(f'{r6(c)} AS {c}' for c in ('open', 'high', 'low', 'close', 'volume'))},
        'event_time timestamp, symbol string, timeframe string, open double, high double, low double, close double, volume double, source string, ingestion_time timestamp' AS types,
        true AS stamped FROM ({_ALL})""",
    "empty_input": f"""SELECT operator, (SELECT count(*) FROM ({_ALL}) WHERE event_time < TIMESTAMP '1900-01-01') AS rows, CAST(n AS BIGINT) AS columns FROM (VALUES
        ('validate', 10), ('dedup_last', 10), ('indicators', 16), ('resample', 10), ('missing_candles', 4), ('gap_fill', 11), ('gap_ranges', 6),
        ('slot_bitmaps', 10), ('candle_geometry', 17)) t(operator, n)""",
    "gap_ranges": _GAPS.format(slots=_SLOTTED.format(rows=_ALL)),
    "gap_ranges_dirty": _GAPS.format(slots=_SLOTTED.format(rows=f"SELECT * FROM ({_DIRTY_GRID}) UNION ALL BY NAME SELECT * FROM ({DAILY_SQL})"))
    + f" UNION ALL SELECT DISTINCT source, symbol, timeframe, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT) FROM ({_DIRTY_GRID}) WHERE timeframe = '1s'",
    "candle_runs": f"""SELECT source, symbol, timeframe, make_timestamp(min(slot) * unit * 1000) AS run_start,
        make_timestamp(max(slot) * unit * 1000) AS run_end, count(*) AS n_candles
        FROM (SELECT *, slot - row_number() OVER (PARTITION BY source, symbol, timeframe ORDER BY slot) AS island FROM ({_SLOTTED.format(rows=_TWO)}))
        GROUP BY source, symbol, timeframe, unit, island""",
    "repair_windows": f"""WITH g AS (SELECT symbol, (p + 1) * 3600000 AS start_ms, slot * 3600000 AS end_ms FROM ({_SLOTTED.format(rows=_ALL)}) WHERE slot > p + 1),
        w AS (SELECT symbol, end_ms, unnest(generate_series(start_ms, end_ms - 1, 7200000)) AS window_start FROM g)
        SELECT symbol, '1h' AS interval, CAST(window_start AS BIGINT) AS window_start, CAST(least(window_start + 7200000, end_ms) AS BIGINT) AS window_end,
          CAST(2 AS BIGINT) AS "limit" FROM w""",
    "completeness_bitmap": f"""SELECT source, symbol, timeframe, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS present,
        CAST(floor(epoch_ms(max(event_time)) / 3600000) - floor(epoch_ms(min(event_time)) / 3600000) + 1 AS BIGINT) AS expected,
        CAST((date_diff('day', CAST(min(event_time) AS DATE), CAST(max(event_time) AS DATE)) + 1) * 24 AS BIGINT) AS estimated,
        {r6('count(*) / (floor(epoch_ms(max(event_time)) / 3600000) - floor(epoch_ms(min(event_time)) / 3600000) + 1)')} AS ratio,
        CAST(floor(epoch_ms(max(event_time)) / 3600000) - floor(epoch_ms(min(event_time)) / 3600000) + 1 AS BIGINT) - count(*) AS missing
        FROM ({_ALL}) GROUP BY 1, 2, 3""",
    "missing_by_month": f"""WITH c AS ({_TWO}),
        r AS (SELECT source, symbol, timeframe, unnest(generate_series(min(event_time), max(event_time), CASE timeframe WHEN '1h' THEN INTERVAL 1 HOUR ELSE INTERVAL 1 DAY END)) AS event_time
              FROM c GROUP BY source, symbol, timeframe)
        SELECT r.source, r.symbol, r.timeframe, year(r.event_time) AS year, month(r.event_time) AS month, count(*) AS n_slots, count(*) - count(c.event_time) AS n_missing
        FROM r LEFT JOIN c ON r.source = c.source AND r.symbol = c.symbol AND r.timeframe = c.timeframe AND r.event_time = c.event_time GROUP BY ALL""",
    "candle_cascade": " UNION ALL ".join(_coarse_sql(tf, start) for tf, start in (
        ("5m", "time_bucket(INTERVAL 5 MINUTE, ts)"), ("1h", "date_trunc('hour', ts)"), ("1d", "date_trunc('day', ts)"))),
    "write_bad_time": f"""SELECT symbol, CASE WHEN CAST(floor(epoch_ms(event_time) / 3600000) AS BIGINT) % 20 = 3 THEN 'garbage'
        ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS time, {r6('close')} AS close FROM ({_ALL})""",
    "kline_dirty": f"""SELECT CASE WHEN NOT bad_time THEN event_time END AS event_time, symbol, timeframe, {r6('CASE WHEN NOT bad_open THEN open END')} AS open,
        {r6('high')} AS high, {r6('CASE WHEN NOT cut THEN low END')} AS low, {r6('CASE WHEN NOT cut THEN close END')} AS close,
        {r6('CASE WHEN NOT cut THEN volume END')} AS volume, 'exchange' AS source, TIMESTAMP '2024-03-01 00:00:00' AS ingestion_time,
        NOT (bad_open OR bad_time OR cut) AS is_valid
        FROM (SELECT *, hr % 50 = 7 AS bad_open, hr % 50 <> 7 AND hr % 70 = 9 AS bad_time, hr % 50 <> 7 AND hr % 70 <> 9 AND hr % 90 = 11 AS cut
              FROM (SELECT *, CAST(floor(epoch_ms(event_time) / 3600000) AS BIGINT) AS hr FROM ({_ALL})))""",
    "fetch_windows_edge": """WITH req AS (
          SELECT event_type AS symbol, epoch_ms(min(date_trunc('day', ts))) AS start_ms, count(*) AS n FROM events GROUP BY 1),
        r AS (SELECT symbol, start_ms, start_ms + ([0, -5, 1, 3600000])[CAST(n % 4 + 1 AS INTEGER)] AS end_ms FROM req),
        w AS (SELECT symbol, interval, end_ms, unnest(CASE WHEN start_ms >= end_ms THEN [] WHEN interval = '1M' THEN [start_ms]
                ELSE generate_series(start_ms, end_ms - 1, 600000) END) AS window_start FROM r, (VALUES ('1m'), ('1M')) t(interval))
        SELECT symbol, interval, CAST(window_start AS BIGINT) AS window_start,
          CAST(CASE WHEN interval = '1M' THEN end_ms ELSE least(window_start + 600000, end_ms) END AS BIGINT) AS window_end, CAST(10 AS BIGINT) AS "limit" FROM w""",
    "ema_nulls": gold_sql(_ALL, extra=f"""SELECT source, symbol, timeframe, event_time, {r6('real_close')} AS close,
        {r6('CASE WHEN NOT gone THEN ema_50 END')} AS ema_50, {r6('CASE WHEN NOT gone THEN close END')} AS ema_1 FROM ({_EMA_NULLS})"""),
    "stream_ema_nulls": gold_sql(_ALL, extra=f"""SELECT source, symbol, timeframe, event_time, {r6('real_close')} AS close,
        {r6('CASE WHEN NOT gone THEN ema_50 END')} AS ema_50 FROM ({_EMA_NULLS})"""),
    "missing_candles_dirty": f"""WITH c AS ({_DIRTY_GRID}) {_DIRTY_MISSING}
        UNION ALL SELECT DISTINCT source, symbol, timeframe, CAST(NULL AS TIMESTAMP) FROM c WHERE timeframe <> '1h'""",
    "gap_fill_dirty": f"""WITH c AS ({_DIRTY_GRID}), m AS ({_DIRTY_MISSING}),
        u AS (SELECT source, symbol, timeframe, event_time, open, high, low, close, volume, false AS is_filled FROM c
              UNION ALL SELECT source, symbol, timeframe, event_time, NULL, NULL, NULL, NULL, 0, true FROM m),
        j AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY source, symbol, timeframe ORDER BY event_time
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc FROM u)
        SELECT event_time, symbol, timeframe, {', '.join(f"{r6(f'CASE WHEN is_filled THEN lc ELSE {c} END')} AS {c}" for c in ('open', 'high', 'low', 'close'))},
          {r6('volume')} AS volume, source, is_filled FROM j""",
    "resample_mixed": f"""SELECT date_trunc('day', event_time) AS event_time, symbol, '1d' AS timeframe,
        {r6('arg_min(open, event_time)')} AS open, {r6('max(high)')} AS high, {r6('min(low)')} AS low,
        {r6('arg_max(close, event_time)')} AS close, {r6('sum(volume)')} AS volume, source, max(ingestion_time) AS ingestion_time
        FROM ({_ALL}) GROUP BY source, symbol, date_trunc('day', event_time)""",
    "lake_files": f"""SELECT 'source=' || source || '/symbol=' || symbol || '/timeframe=' || timeframe || '/year=' || year(event_time)
          || '/month=' || strftime(any_value(event_time), '%m') AS folder, CAST(ceil(count(*) / 500) AS BIGINT) AS files
        FROM ({_ALL}) GROUP BY source, symbol, timeframe, year(event_time), month(event_time)""",
    "missing_column": f"SELECT 'Missing required columns: {{''volume''}}' AS message, count(*) AS rows FROM ({DIRTY_SQL})",
    "strict_dates": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) AS next_day FROM orders",
    "utc_write": f"SELECT {OHLCV_SELECT} FROM ({_ALL})",
    "write_dedup": f"SELECT {OHLCV_SELECT} FROM ({DEDUP_SQL})",
    "backfill_reland": f"""SELECT {_BACKFILL_SELECT} FROM (SELECT * FROM ({_ALL}) WHERE event_time < TIMESTAMP '2024-01-15'
        UNION ALL SELECT * FROM ({_CORRECTED}) WHERE event_time >= TIMESTAMP '2024-01-15')""",
    "backfill_merge": f"""SELECT {_BACKFILL_SELECT} FROM (
        SELECT * FROM ({_ALL}) WHERE event_time < TIMESTAMP '2024-01-10' OR event_time >= TIMESTAMP '2024-01-12'
        UNION ALL SELECT * FROM ({_CORRECTED}) WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-12')""",
    "backfill_stats": f"""WITH c AS ({_ALL}), s AS (SELECT count(DISTINCT symbol) AS n FROM c WHERE event_time >= TIMESTAMP '2024-01-15')
        SELECT (SELECT count(*) FROM c) + (SELECT count(*) FROM c WHERE event_time >= TIMESTAMP '2024-01-15') + n AS total_records,
          (SELECT count(*) FROM c) + (SELECT count(*) FROM c WHERE event_time >= TIMESTAMP '2024-01-15') AS valid_records,
          n AS invalid_records, n AS unparsed_pages,
          CAST((SELECT sum(ceil(k / 500)) FROM (SELECT count(*) AS k FROM c GROUP BY symbol, year(event_time), month(event_time))) AS BIGINT) AS files,
          'Column ''event_time'' has ' || n || ' null values' AS first_error FROM s""",
    "candles_1h": f"SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})",
    "resample_1d": f"""SELECT date_trunc('day', event_time) AS event_time, symbol, '1d' AS timeframe,
        {r6('arg_min(open, event_time)')} AS open, {r6('max(high)')} AS high, {r6('min(low)')} AS low,
        {r6('arg_max(close, event_time)')} AS close, {r6('sum(volume)')} AS volume, source, max(ingestion_time) AS ingestion_time
        FROM ({CANDLES_SQL.format(where='', price='value')}) GROUP BY source, symbol, date_trunc('day', event_time)""",
    "kline_parse": f"""SELECT event_time, symbol, timeframe, {r6('open')} AS open, {r6('high')} AS high, {r6('low')} AS low,
        {r6('close')} AS close, {r6('volume')} AS volume, 'exchange' AS source, TIMESTAMP '2024-03-01 00:00:00' AS ingestion_time
        FROM ({CANDLES_SQL.format(where='', price='value')})""",
    "kline_vwap": f"""SELECT date_trunc('hour', ts) AS event_time, event_type AS symbol, {r6('sum(value * value)')} AS quote_volume,
        count(*) AS trades, {r6('coalesce(sum(CASE WHEN value >= 100.0 THEN value END), 0)')} AS taker_buy_volume,
        {r6('CASE WHEN sum(value) = 0 THEN NULL ELSE sum(value * value) / sum(value) END')} AS vwap
        FROM events GROUP BY 1, 2""",
    "fetch_windows": """WITH req AS (
          SELECT event_type AS symbol, epoch_ms(min(date_trunc('day', ts))) AS start_ms,
                 epoch_ms(max(date_trunc('day', ts))) + 86400000 AS end_ms FROM events GROUP BY 1),
        iv AS (SELECT interval, CAST(ms AS BIGINT) AS ms FROM (VALUES ('1m', 60000), ('5m', 300000), ('1h', 3600000)) t(interval, ms)),
        w AS (SELECT symbol, interval, unnest(generate_series(start_ms, end_ms - 1, ms * 1000)) AS window_start, ms * 1000 AS step, end_ms
              FROM req, iv)
        SELECT symbol, interval, window_start, least(window_start + step, end_ms) AS window_end, CAST(1000 AS BIGINT) AS "limit" FROM w""",
    "valid_rows": f"SELECT {OHLCV_SELECT} FROM ({_CLEAN}) WHERE {_VALID}",
    "invalid_rows": f"SELECT {OHLCV_SELECT} FROM ({_CLEAN}) WHERE NOT coalesce({_VALID}, false)",
    "strict_rows": f"SELECT {OHLCV_SELECT} FROM ({_CLEAN}) WHERE {_STRICT}",
    "violation_counts": f"""SELECT count_if(event_time IS NULL) AS null_event_time, count_if(symbol IS NULL) AS null_symbol,
        count_if(timeframe IS NULL) AS null_timeframe, count_if(o IS NULL) AS null_open, count_if(h IS NULL) AS null_high,
        count_if(l IS NULL) AS null_low, count_if(c IS NULL) AS null_close, count_if(v IS NULL) AS null_volume,
        count_if(source IS NULL) AS null_source,
        count_if(h < greatest(o, c)) AS high_below_body, count_if(l > least(o, c)) AS low_above_body,
        count_if(h < l) AS high_below_low, count_if(v < 0) AS negative_volume, count(*) AS total FROM ({_CLEAN})""",
    "validation_messages": f"""WITH k AS (SELECT count_if(event_time IS NULL) AS n0, count_if(symbol IS NULL) AS n1,
        count_if(timeframe IS NULL) AS n2, count_if(o IS NULL) AS n3, count_if(h IS NULL) AS n4, count_if(l IS NULL) AS n5,
        count_if(c IS NULL) AS n6, count_if(v IS NULL) AS n7, count_if(source IS NULL) AS n8,
        count_if(h < greatest(o, c)) AS v0, count_if(l > least(o, c)) AS v1, count_if(h < l) AS v2, count_if(v < 0) AS v3
        FROM ({_CLEAN})),
        m AS (
          SELECT 0 AS ord, n0 AS n, 'Column ''event_time'' has ' || n0 || ' null values' AS message FROM k UNION ALL
          SELECT 1, n1, 'Column ''symbol'' has ' || n1 || ' null values' FROM k UNION ALL
          SELECT 2, n2, 'Column ''timeframe'' has ' || n2 || ' null values' FROM k UNION ALL
          SELECT 3, n3, 'Column ''open'' has ' || n3 || ' null values' FROM k UNION ALL
          SELECT 4, n4, 'Column ''high'' has ' || n4 || ' null values' FROM k UNION ALL
          SELECT 5, n5, 'Column ''low'' has ' || n5 || ' null values' FROM k UNION ALL
          SELECT 6, n6, 'Column ''close'' has ' || n6 || ' null values' FROM k UNION ALL
          SELECT 7, n7, 'Column ''volume'' has ' || n7 || ' null values' FROM k UNION ALL
          SELECT 8, n8, 'Column ''source'' has ' || n8 || ' null values' FROM k UNION ALL
          SELECT 100, v0, v0 || ' records have high < max(open, close)' FROM k UNION ALL
          SELECT 101, v1, v1 || ' records have low > min(open, close)' FROM k UNION ALL
          SELECT 102, v2, v2 || ' records have high < low' FROM k UNION ALL
          SELECT 103, v3, v3 || ' records have negative volume' FROM k)
        SELECT CAST(ord AS BIGINT) AS ord, message FROM m WHERE n > 0""",
    "run_stats": f"""SELECT symbol, timeframe,
        strftime(min(event_time), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS start_date,
        strftime(max(event_time), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS end_date,
        count(*) AS total_records, count_if(coalesce({_VALID}, false)) AS valid_records,
        count(*) - count_if(coalesce({_VALID}, false)) AS invalid_records
        FROM ({_CLEAN}) GROUP BY symbol, timeframe""",
    "record_counts": f"""SELECT symbol, timeframe, source, count(*) AS record_count FROM ({_CLEAN}) WHERE {_VALID}
        GROUP BY symbol, timeframe, source""",
    "unknown_timeframes": f"""SELECT event_time, symbol, timeframe FROM (
        SELECT event_time, symbol, (['1m', '1M', '2m', '1h', '7d'])[CAST(hour(event_time) % 5 + 1 AS INTEGER)] AS timeframe
        FROM ({DIRTY_SQL})) WHERE timeframe NOT IN ('1m','3m','5m','15m','30m','1h','2h','4h','6h','8h','12h','1d','3d','1w','1M')""",
    "dedup_last": f"SELECT {OHLCV_SELECT} FROM ({DEDUP_SQL})",
    "range_filter": f"""SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})
        WHERE event_time >= TIMESTAMP '2024-01-05' AND event_time < TIMESTAMP '2024-01-13'""",
    "partition_counts": f"""SELECT source, symbol, timeframe, year(event_time) AS year, month(event_time) AS month, count(*) AS rows
        FROM ({CANDLES_SQL.format(where='', price='value')}) GROUP BY 1, 2, 3, 4, 5""",
    "distinct_years": f"SELECT DISTINCT year(event_time) AS year FROM ({DAILY_SQL})",
    "row_index": f"""SELECT source, symbol, timeframe, event_time, {r6('close')} AS close,
        row_number() OVER (PARTITION BY source, symbol, timeframe ORDER BY event_time) - 1 AS idx
        FROM ({CANDLES_SQL.format(where='', price='value')})""",
    "chunk_no": f"""SELECT source, symbol, timeframe, event_time, idx, CAST(floor(idx / 100) AS BIGINT) AS chunk FROM (
        SELECT *, row_number() OVER (PARTITION BY source, symbol, timeframe ORDER BY event_time) - 1 AS idx
        FROM ({CANDLES_SQL.format(where='', price='value')}))""",
    "sma_200": f"""SELECT source, symbol, timeframe, event_time, {r6('close')} AS close,
        {r6('avg(close) OVER (PARTITION BY source, symbol, timeframe ORDER BY event_time ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)')} AS sma_200
        FROM ({CANDLES_SQL.format(where='', price='value')})""",
    "ema_50": _gold_from(CANDLES_SQL.format(where="", price="value"), f"source, symbol, timeframe, event_time, {r6('close')} AS close, {r6('ema_50')} AS ema_50"),
    "macd": _gold_from(CANDLES_SQL.format(where="", price="value"), f"source, symbol, timeframe, event_time, {r6('macd')} AS macd, {r6('macd_signal')} AS macd_signal, {r6('macd_hist')} AS macd_hist"),
    "rsi_14": _gold_from(CANDLES_SQL.format(where="", price="value"), f"source, symbol, timeframe, event_time, {r6('close')} AS close, {r6('rsi_14')} AS rsi_14"),
    "gold": _gold_from(DEDUP_SQL, GOLD_SELECT),
    "stream_gold": _gold_from(DEDUP_SQL, GOLD_SELECT),
    "stream_gold_late": f"""SELECT source, symbol, timeframe, count(*) AS late FROM ({_ALL}) c
        WHERE event_time >= TIMESTAMP '2024-01-04' AND event_time < TIMESTAMP '2024-01-20'
          AND EXISTS (SELECT 1 FROM ({_ALL}) d WHERE d.symbol = c.symbol AND d.event_time >= TIMESTAMP '2024-01-20') GROUP BY ALL""",
    "gold_incremental": _gold_from(DAILY_SQL, _sel(GOLD_COLS, DOUBLE_COLS, ORDER_DECIMALS)),
    "stream_keep_last": f"SELECT {OHLCV_SELECT} FROM ({DEDUP_SQL})",
    "stream_candles_upsert": f"SELECT {OHLCV_SELECT} FROM ({_ALL})",
    "gold_1m": _gold_from(" UNION ALL ".join(_ALL.replace("'1h' AS timeframe", f"'{tf}' AS timeframe").replace("date_trunc('hour'", f"date_trunc('{unit}'")
                                             for tf, unit in (("1m", "minute"), ("1d", "day"))), GOLD_SELECT),
    "indicator_params": gold_sql(CANDLES_SQL.format(where="", price="value"), 20, 20, 5, 35, 5, 7,
                                 extra="SELECT source, symbol, timeframe, event_time, "
                                 + _sel(["sma_20", "ema_20", "rsi_7", "macd", "macd_signal", "macd_hist"], DOUBLE_COLS) + " FROM g"),
    "daily_gold": _gold_from(DAILY_SQL, _sel(GOLD_COLS, DOUBLE_COLS, ORDER_DECIMALS)),
    "ma_cross": gold_sql(DEDUP_SQL, extra=f"""SELECT source, symbol, timeframe, event_time,
        CASE WHEN ema_50 > sma_200 THEN 'up' ELSE 'down' END AS direction, {r6('close')} AS value FROM (
        SELECT *{_LAGGED}) WHERE (ema_50 > sma_200 AND p_e <= p_s) OR (ema_50 < sma_200 AND p_e >= p_s)"""),
    "macd_cross": gold_sql(DEDUP_SQL, extra=f"""SELECT source, symbol, timeframe, event_time,
        CASE WHEN macd > macd_signal THEN 'up' ELSE 'down' END AS direction, {r6('macd')} AS value FROM (
        SELECT *{_LAGGED}) WHERE (macd > macd_signal AND p_m <= p_g) OR (macd < macd_signal AND p_m >= p_g)"""),
    "ma_cross_year": gold_sql(DAILY_SQL, extra=f"""SELECT source, symbol, timeframe, event_time,
        CASE WHEN ema_50 > sma_200 THEN 'up' ELSE 'down' END AS direction, {r6('close')} AS value FROM (
        SELECT *, lag(ema_50) OVER w AS p_e, lag(sma_200) OVER w AS p_s
        FROM g WINDOW w AS (PARTITION BY source, symbol, timeframe, year ORDER BY event_time))
        WHERE (ema_50 > sma_200 AND p_e <= p_s) OR (ema_50 < sma_200 AND p_e >= p_s)"""),
    "rsi_zones": _gold_from(DEDUP_SQL, f"""source, symbol, timeframe, event_time, {r6('rsi_14')} AS rsi_14,
        CASE WHEN rsi_14 < 30 THEN 'oversold' WHEN rsi_14 > 70 THEN 'overbought' END AS zone""",
                             "WHERE rsi_14 < 30 OR rsi_14 > 70"),
    "candle_geometry": f"""SELECT source, symbol, timeframe, event_time, close >= open AS is_up,
        {r6('least(open, close)')} AS body_low, {r6('greatest(open, close)')} AS body_high, {r6('abs(close - open)')} AS body_height,
        {r6('low')} AS wick_low, {r6('high')} AS wick_high, {r6('epoch_us(event_time) / 86400000000.0')} AS day_num
        FROM ({CANDLES_SQL.format(where='', price='value')})""",
    "year_feed": _gold_from(DAILY_SQL, "year, symbol, event_time, " + _sel(
        ["open", "high", "low", "close", "volume", "sma_200", "ema_50", "rsi_14", "macd", "macd_signal"], DOUBLE_COLS,
        ORDER_DECIMALS)),
    "top_30": _gold_from(DEDUP_SQL, GOLD_SELECT, order="ORDER BY event_time, symbol LIMIT 30"),
    "missing_candles": f"""WITH c AS ({CANDLES_SQL.format(where='', price='value')}),
        r AS (SELECT source, symbol, timeframe, min(event_time) AS lo, max(event_time) AS hi FROM c GROUP BY 1, 2, 3),
        grid AS (SELECT source, symbol, timeframe, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS event_time FROM r)
        SELECT source, symbol, timeframe, event_time FROM grid ANTI JOIN c USING (source, symbol, timeframe, event_time)""",
    "gap_fill": f"""WITH c AS ({CANDLES_SQL.format(where='', price='value')}),
        r AS (SELECT source, symbol, timeframe, min(event_time) AS lo, max(event_time) AS hi FROM c GROUP BY 1, 2, 3),
        grid AS (SELECT source, symbol, timeframe, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS event_time FROM r),
        j AS (SELECT g.source, g.symbol, g.timeframe, g.event_time, c.open, c.high, c.low, c.close, c.volume,
                     c.close IS NULL AS is_filled,
                     last_value(c.close IGNORE NULLS) OVER (PARTITION BY g.source, g.symbol, g.timeframe ORDER BY g.event_time
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc
              FROM grid g LEFT JOIN c USING (source, symbol, timeframe, event_time))
        SELECT event_time, symbol, timeframe,
          {r6('CASE WHEN is_filled THEN lc ELSE open END')} AS open, {r6('CASE WHEN is_filled THEN lc ELSE high END')} AS high,
          {r6('CASE WHEN is_filled THEN lc ELSE low END')} AS low, {r6('CASE WHEN is_filled THEN lc ELSE close END')} AS close,
          {r6('CASE WHEN is_filled THEN 0 ELSE volume END')} AS volume, source, is_filled FROM j""",
    "completeness": f"""SELECT source, symbol, timeframe, min(event_time) AS first_event, max(event_time) AS last_event,
        count(*) AS present,
        CAST(floor(epoch_ms(max(event_time)) / 3600000) - floor(epoch_ms(min(event_time)) / 3600000) + 1 AS BIGINT) AS expected,
        CAST((date_diff('day', CAST(min(event_time) AS DATE), CAST(max(event_time) AS DATE)) + 1) * 24 AS BIGINT) AS estimated,
        {r6('count(*) / (floor(epoch_ms(max(event_time)) / 3600000) - floor(epoch_ms(min(event_time)) / 3600000) + 1)')} AS ratio
        FROM ({CANDLES_SQL.format(where='', price='value')}) GROUP BY 1, 2, 3""",
    "parquet_roundtrip": f"SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})",
    "partition_read": f"""SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})
        WHERE source = 'events' AND symbol = 'click' AND timeframe = '1h' AND year(event_time) = 2024 AND month(event_time) = 1""",
    "lake_info": f"""SELECT source, symbol, timeframe, count(*) AS total_rows, min(event_time) AS first_event,
        max(event_time) AS last_event FROM ({CANDLES_SQL.format(where='', price='value')}) GROUP BY 1, 2, 3""",
    "csv_roundtrip": f"""SELECT source, symbol, timeframe, event_time, {r6('open')} AS open, {r6('high')} AS high,
        {r6('low')} AS low, {r6('close')} AS close, {r6('volume')} AS volume FROM ({CANDLES_SQL.format(where='', price='value')})""",
    "json_records": f"SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})",
    "medallion_gold": _gold_from(CANDLES_SQL.format(where="", price="value"), GOLD_SELECT),
    "stream_candles": f"""SELECT {OHLCV_SELECT} FROM ({CANDLES_SQL.format(where='', price='value')})
        WHERE event_time + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_dedup": "SELECT DISTINCT event_type AS symbol, date_trunc('minute', ts) AS event_time FROM events",
    "stream_ema": _gold_from(CANDLES_SQL.format(where="", price="value"), f"source, symbol, timeframe, event_time, {r6('close')} AS close, {r6('ema_50')} AS ema_50"),
    "backfill": f"""SELECT event_time, symbol, timeframe, {r6('open')} AS open, {r6('high')} AS high, {r6('low')} AS low,
        {r6('close')} AS close, {r6('volume')} AS volume, 'exchange' AS source FROM ({CANDLES_SQL.format(where='', price='value')})
        WHERE symbol = 'click' AND event_time >= TIMESTAMP '2024-01-03' AND event_time < TIMESTAMP '2024-01-21'""",
    "multi_timeframe": """SELECT 'events' AS source, event_type AS symbol, tf AS timeframe, count(DISTINCT slot) AS candles,
        round(CAST(sum(value) AS DOUBLE) + 2.5e-09, 6) AS volume FROM (
          SELECT event_type, value, tf, CASE tf WHEN '1h' THEN date_trunc('hour', ts)
              WHEN '1d' THEN date_trunc('day', ts)
              ELSE make_timestamp(CAST(floor(epoch_us(ts) / 14400000000) * 14400000000 AS BIGINT)) END AS slot
          FROM events, (VALUES ('1h'), ('4h'), ('1d')) t(tf))
        GROUP BY 1, 2, 3""",
    "line_candles": f"SELECT event_time, symbol, timeframe, {_sel(['open', 'high', 'low', 'close', 'volume'], DOUBLE_COLS, ORDER_DECIMALS)}, source, ingestion_time FROM ({LINE_DAILY_SQL})",
    "line_gold": _gold_from(LINE_DAILY_SQL, _sel(GOLD_COLS, DOUBLE_COLS, ORDER_DECIMALS)),
    "append_merge": f"SELECT {OHLCV_SELECT} FROM ({DEDUP_SQL})",
}
