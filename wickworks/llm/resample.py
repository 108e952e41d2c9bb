"""Quality classifier by importance resampling.

Two generative models over hashed unigrams and bigrams, one of the target
texts (labelled good) and one of all raw texts, give each text a log weight:
the logarithm of the ratio of its probabilities under the two.  Gumbel noise
added to the log weights and a top-k cut sample texts without replacement in
proportion to their weights.

Tokens are runs of letters and digits, and runs of other signs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import as_long, inside, keyed_texts, mix, text_slices, window_hashes, word_hashes, written

BUCKETS = 65_536
TARGET_SAMPLE = 50_000


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of its text, bucket) of each word and each pair of neighbours in the texts."""
    starts, h = word_hashes(pc.replace_substring_regex(pc.fill_null(texts, ""), r"([^\p{L}\p{N}\s]+)", r" \1 "))
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pair = np.flatnonzero(inside(starts, 2))
    pairs = window_hashes(h, 2)[pair]
    return np.concatenate((row, row[pair])), (np.concatenate((mix(h), pairs)) % np.uint64(buckets)).astype(np.int64)


def log_ratios(docs: DataFrame, good: DataFrame, buckets: int = BUCKETS, sample: int = TARGET_SAMPLE, smoothing: float = 1.0) -> np.ndarray:
    """log(target / raw) of each bucket.

    The raw model counts all of ``docs`` (ord, th, text).  The target model
    counts those whose ord is in ``good`` (ord), of which at most ``sample``
    are taken, those of the least hashes; that bounds what is broadcast.
    """
    chosen = good.distinct().orderBy(F.xxhash64("ord"), "ord").limit(sample).collect()
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in chosen], np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                row, bucket = features(part.column(2), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                is_good = np.isin(part.column(0).to_numpy(zero_copy_only=False), shared.value)
                target += np.bincount(bucket[is_good[row]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    sums = docs.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.full(buckets, smoothing), np.full(buckets, smoothing)
    raw[sums["bucket"]] += sums["raw"]
    target[sums["bucket"]] += sums["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def scored(docs: DataFrame, ratios: np.ndarray, seed: int = 1) -> DataFrame:
    """(ord, th, log_weight, noisy): the log weight alone and with its Gumbel noise.

    The noise is a function of (ord, th, seed), so reruns agree.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                row, bucket = features(part.column(2), len(of))
                weight = np.bincount(row, of[bucket], minlength=part.num_rows)
                key = mix(part.column(0).to_numpy().astype(np.uint64)) ^ part.column(1).to_numpy().view(np.uint64)
                u = ((mix(key + np.uint64(seed)) >> np.uint64(12)).astype(float) + 0.5) / 2**52
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(weight), pa.array(weight - np.log(-np.log(u)))], names=["ord", "th", "log_weight", "noisy"])

    return docs.mapInArrow(score, "ord long, th long, log_weight double, noisy double")


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest number of ``column``, exactly; None if there are fewer.

    Counts by the number's leading bits narrow it down, 14 bits at a time, so
    that the driver sees at most 2**14 counts a round whatever the table's size.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k < 1 or df.count() < k:
        return None
    above = 0  # how many lie over ``high``'s bin
    steps = 1 << 14
    while low < high:
        width = (high - low) / steps
        if low + width <= low or high - width >= high:  # neighbours as numbers go
            for value, n in df.where(F.col(column).between(low, high)).groupBy(column).count().orderBy(F.desc(column)).limit(4 * steps).collect():
                above += n
                if above >= k:
                    return value
            raise AssertionError("the bins lost a number")
        number = F.least(F.greatest(F.floor((F.col(column) - low) / width), F.lit(0)), F.lit(steps - 1))
        bins = df.where(F.col(column).between(low, high)).groupBy(number.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for b in sorted(bins, key=lambda b: -b["bin"]):
            if above + b["n"] >= k:
                low, high = b["low"], b["high"]
                break
            above += b["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", seed: int = 1, **options) -> DataFrame:
    """Sample the texts that look like the labelled good ones.

    Returns doc_id, log_weight, noisy (log weight with Gumbel noise), selected:
    a row per input row.  ``share`` of all rows is selected, by default the
    share of good rows among the labelled and two standard errors more, so that
    a chance shortfall of good labels doesn't cut off good texts; none if
    nothing is labelled.  Ties with the last selected are selected too.  A null or empty text has log
    weight 0.  Label rows with a null in them are ignored; a document labelled
    more than once is good if all its labels are.
    """
    of = labels.select(F.col(doc_id).cast("long").alias("ord"), F.col(quality).alias("quality")).dropna().groupBy("ord").agg(F.min("quality").alias("quality"))
    texts = keyed_texts(docs, doc_id, text)
    ratios = log_ratios(texts, of.where("quality = 1").select("ord"), **options)
    if share is None:
        good, n = of.agg(F.count_if(F.col("quality") == 1), F.count("*")).first()
        p = good / n if n else 0.0
        share = min(1.0, p + 2 * math.sqrt(p * (1 - p) / n)) if n else 0.0
    table = written(scored(texts, ratios, seed), "resample-scores")
    least = kth_largest(table, "noisy", round(share * table.count()))
    chosen = F.col("noisy") >= least if least is not None else F.lit(False)
    back = F.when(F.col("ord") != F.lit(2**63 - 1), F.col("ord"))
    return table.select(back.alias("doc_id"), "log_weight", "noisy", chosen.alias("selected"))
