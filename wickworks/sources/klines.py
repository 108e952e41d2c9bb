"""Exchange kline pages.

A landed page is one JSON document: an array of klines, each a 12-position
array mixing integers (times, trade count) and decimal strings (prices,
volumes).  Reading pages is a text scan plus ``from_json`` as
``array<array<string>>`` (integers arrive as their text) and one ``explode``;
every file is split into rows on the executors, nothing passes the driver.

The HTTP paging itself is not part of this library: the fetch plan is a table
of (symbol, interval, window_start, window_end) request windows that any
landing job can execute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.functions.numeric import to_double
from wickworks.functions.time import from_epoch_ms, timeframe_ms
from wickworks.schema import KLINE_POSITIONS, MAX_PAGE_LIMIT, OHLCV_COLUMNS

PAGE_TYPE = "array<array<string>>"


def read_pages(spark: SparkSession, path: str, page_per_file: bool = True) -> DataFrame:
    """Landed pages: ``page`` (array<array<string>>, null if it can't be parsed), ``file``,
    ``landing`` (sorts pages in the order they landed) and the partition columns of the path.

    ``page_per_file=True`` reads each file as one JSON document (one request's
    response per file); ``False`` reads JSON Lines, one page per line.  The landing
    order is the ``landed_at=`` folder if there is one, then the file's time, its
    name, and the page's place in it.  Blank pages are left out."""
    raw = spark.read.text(path, wholetext=page_per_file).where(F.trim("value") != "")
    run = F.col("landed_at") if "landed_at" in raw.columns else F.lit(None).cast("int")
    place = (F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    landing = F.struct(run.alias("run"), F.col("_metadata.file_modification_time").alias("modified"),
                       F.col("_metadata.file_path").alias("file"), *place)
    return raw.select(
        F.from_json("value", PAGE_TYPE).alias("page"), F.col("_metadata.file_path").alias("file"), landing.alias("landing"),
        *[c for c in raw.columns if c != "value"],
    )


def explode_pages(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """Pages -> one row per kline ``k`` (array<string>), keeping the other columns.

    A page that can't be parsed gives one row with null ``k``, which fails
    validation and so is counted, not lost."""
    others = [c for c in pages.columns if c != page_col]
    corrupt = F.array(F.lit(None).cast("array<string>"))
    return pages.select(*others, F.posexplode(F.coalesce(F.col(page_col), corrupt)).alias("kpos", "k"))


def _pos(k: Column, name: str) -> Column:
    return F.get(k, F.lit(KLINE_POSITIONS[name]))


def klines_to_ohlcv(
    klines: DataFrame,
    symbol: Column | str,
    timeframe: Column | str,
    source: Column | str = "binance",
    ingestion_time: Column | None = None,
    k: str = "k",
    extras: bool = False,
) -> DataFrame:
    """Kline arrays -> contract rows (C1): open time ms -> UTC time, prices -> double.

    ``symbol``/``timeframe``/``source`` may be literals or columns; one
    ``ingestion_time`` per run (default: the query's current time).  A field that is
    missing or can't be read is null: such a kline fails validation, and the others
    of its page don't."""
    kc = F.col(k)

    def lit_or_col(v):
        return v if isinstance(v, Column) else F.lit(v)

    cols = {
        "event_time": from_epoch_ms(_pos(kc, "open_time").try_cast("bigint")),
        "symbol": lit_or_col(symbol),
        "timeframe": lit_or_col(timeframe),
        "open": to_double(_pos(kc, "open")),
        "high": to_double(_pos(kc, "high")),
        "low": to_double(_pos(kc, "low")),
        "close": to_double(_pos(kc, "close")),
        "volume": to_double(_pos(kc, "volume")),
        "source": lit_or_col(source),
        "ingestion_time": ingestion_time if ingestion_time is not None else F.current_timestamp(),
    }
    out = [cols[c].alias(c) for c in OHLCV_COLUMNS]
    if extras:
        out += [
            to_double(_pos(kc, "quote_volume")).alias("quote_volume"),
            _pos(kc, "trades").try_cast("bigint").alias("trades"),
            to_double(_pos(kc, "taker_buy_volume")).alias("taker_buy_volume"),
        ]
    keep = [c for c in klines.columns if c not in cols and c != k]
    return klines.select(*keep, *out)


def fetch_windows(requests: DataFrame, limit: int = MAX_PAGE_LIMIT) -> DataFrame:
    """Request windows for paging (A3): from ``start_ms`` while < ``end_ms``, each
    window ``min(limit, 1000)`` candles of ``interval`` long.

    Input columns: symbol, interval, start_ms, end_ms.  The windows of one request
    are generated by ``sequence`` in the task that holds the request row (about
    one row per 1000 candles).  A request whose range is empty has no windows; an
    unknown interval raises."""
    limit = min(limit, MAX_PAGE_LIMIT)
    known = timeframe_ms(F.col("interval"))
    unknown = F.raise_error(F.concat(F.lit("Invalid interval: "), F.coalesce("interval", F.lit("null"))))
    step = F.coalesce(known, unknown.cast("bigint")) * F.lit(limit)
    requests = requests.where((F.col("start_ms") < F.col("end_ms")) | known.isNull())
    months = F.make_ym_interval(F.lit(0), F.lit(limit))
    # "1M" pages step by calendar months, not by the 30-day constant
    monthly = F.transform(
        F.sequence(F.timestamp_millis("start_ms"), F.timestamp_millis(F.col("end_ms") - 1), months),
        lambda t: F.unix_millis(t),
    )
    fixed = F.sequence(F.col("start_ms"), F.col("end_ms") - F.lit(1), step)
    is_month = F.col("interval") == "1M"
    out = requests.withColumn("window_start", F.explode(F.when(is_month, monthly).otherwise(fixed)))
    next_start = F.when(is_month, F.unix_millis(F.timestamp_millis("window_start") + months)).otherwise(
        F.col("window_start") + step
    )
    return out.select(
        "symbol",
        "interval",
        "window_start",
        F.least(next_start, F.col("end_ms")).alias("window_end"),
        F.lit(limit).alias("limit"),
    )
