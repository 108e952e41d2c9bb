"""Importance resampling towards a target distribution, on Arrow kernels.

The features of a text are its runs of one to three consecutive words, hashed
to buckets by CRC-32.  A bucket's gain is the logarithm of the ratio of its
share in the target texts to its share in all documents; a document's weight is
the sum of its features' gains, and Gumbel noise added to the weights makes the
highest scores a sample without replacement in proportion to the ratios.

A slice of texts is lower-cased, split and flattened to one list of words by
Arrow kernels and dictionary-encoded.  The dictionary's indices, shifted by one
place and two, are the pairs and triples; only distinct ones get a CRC, put
together from those of their words, and gains are taken by bucket and summed
over each text's stretch.  No n-gram is ever written out as text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickworks.llm.base import hidden, row_order, text_slices, written
from wickworks.llm.order import numbered
from wickworks.llm.resample import kth_largest

BUCKETS = 10_000
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_WORDS = 20
SHARE = (5, 100)
SEED = 42


def _zero_bytes() -> list[np.ndarray]:
    """For k = 0, 1, ...: what 2**k zero bytes after a message do to its CRC, for each value of its four bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    step = np.empty((4, 256), np.uint32)
    for j in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
        step[j] = table[x & 255] ^ (x >> 8)
    steps = [step]
    for _ in range(30):
        steps.append(np.stack([_apply(steps[-1], row) for row in steps[-1]]))
    return steps


def _apply(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return step[0][crc & 255] ^ step[1][(crc >> 8) & 255] ^ step[2][(crc >> 16) & 255] ^ step[3][crc >> 24]


_STEPS = _zero_bytes()


def followed(crc: np.ndarray, n: np.ndarray, by: np.ndarray) -> np.ndarray:
    """CRC of each message followed by another one of ``n`` bytes and CRC ``by``."""
    crc, n = crc.copy(), n.astype(np.int64)
    for k, step in enumerate(_STEPS):
        if not (n >> k).any():
            break
        at = np.flatnonzero((n >> k) & 1)
        crc[at] = _apply(step, crc[at])
    return crc ^ by


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, index of each key among them)."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy(zero_copy_only=False)


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, list[np.ndarray]]:
    """(number of words of each text, [bucket of each word, of each pair, of each triple]).

    Each list is in the texts' order; a text of n words has n, n - 1 and n - 2, or none.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN_WORDS)
    words, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    words, parent = pc.filter(words, full), pc.filter(parent, full).to_numpy(zero_copy_only=False)
    counts = np.bincount(parent, minlength=len(texts)).astype(np.int64)
    if not len(words):
        return counts, [np.zeros(0, np.int64)] * 3
    coded = pc.dictionary_encode(words)
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    size = np.fromiter(map(len, names), np.int64, len(names))
    after_space = followed(np.full(len(names), zlib.crc32(b" "), np.uint32), size, crc)
    out = [(crc % np.uint32(buckets)).astype(np.int64)[code]]

    run, run_crc = code, crc  # the run of words that begins at each place, as an index into ``run_crc``
    for n in (2, 3):
        if len(parent) < n:
            out.append(np.zeros(0, np.int64))
            continue
        # the last places of a text begin no run: what stands there is not looked at
        keys, run = _distinct(run[: len(code) - n + 1] * len(names) + code[n - 1 :])
        last = keys % len(names)
        run_crc = followed(run_crc[keys // len(names)], size[last] + 1, after_space[last])
        run = run.astype(np.int64)
        out.append((run_crc % np.uint32(buckets)).astype(np.int64)[run[parent[: len(run)] == parent[n - 1 :]]])
    return counts, out


def n_runs(counts: np.ndarray) -> list[np.ndarray]:
    """Words, pairs and triples of texts of ``counts`` words."""
    return [np.maximum(counts - j, 0) for j in range(3)]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts`` (one column) in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                for found in features(part.column(0), buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.toDF("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in all)) of each bucket, both with one feature more a bucket."""
    s, t, n = raw.astype(float), target.astype(float), len(raw)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """The noise of a document, in thousandths: a function of its id and the seed. A null id counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def weighed(docs: DataFrame, of: np.ndarray, at: int) -> DataFrame:
    """``docs`` with n_words, n_features and weight of the text in column number ``at``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[at]):
                counts, found = features(part.column(at), len(of))
                weight = np.zeros(len(counts), np.int64)
                for n, buckets in zip(n_runs(counts), found):
                    total = np.concatenate(([0], np.cumsum(of.take(buckets))))
                    ends = np.cumsum(n)
                    weight += total[ends] - total[ends - n]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts), pa.array(sum(n_runs(counts))), pa.array(weight)], names=[*part.schema.names, "n_words", "n_features", "weight"])

    new = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    return docs.mapInArrow(weigh, T.StructType([*docs.schema.fields, *new]))


def resampled(docs: DataFrame, target: DataFrame, keep: Sequence[str] | None = None, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS,
              buckets: int = BUCKETS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Score every document by its likeness to ``target`` and draw the share with the highest scores.

    Returns the columns ``keep`` of ``docs`` (default: all) and n_words,
    n_features, weight, score, rank, all long; columns of these names are
    replaced.  Of the N documents of at least ``least_words`` words
    floor(N * share) are drawn: rank is 1, 2, 3, ... from the highest score, ties
    to the smaller doc_id (null last), and null for the rest.  A null or empty
    text has no features and weight 0; without target texts all shares are taken
    against even ones.  Repeated rows are drawn each by itself; of rows equal in
    score and id the order is theirs in the input.  Counts cover every text in
    full; the driver sees one row a bucket, one a range of ranks.
    """
    of = gains(bucket_counts(docs.select(text), buckets), bucket_counts(target.select(target_text), buckets))
    names = list(docs.columns if keep is None else keep)
    rows = hidden(docs.select(*names, F.col(doc_id).alias("_id"), F.col(text).alias("_text")))
    key, body = f"c{len(names)}", f"c{len(names) + 1}"
    found = weighed(rows, of, len(names) + 1).drop(body).withColumn("score", F.col("weight") + gumbel(F.col(key), seed))
    scored = written(found, "gains-scores")
    enough = F.col("n_words") >= least_words
    k = scored.where(enough).count() * share[0] // share[1]
    least = kth_largest(scored.where(enough).select("score"), "score", k)
    out = [*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in NEW], *NEW[:-1]]
    if least is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    high = enough & (F.col("score") >= least)
    top = numbered(scored.where(high), F.desc("score"), row_order(key), name="rank")
    rank = F.when(F.col("rank") <= k, F.col("rank")).alias("rank")
    return top.select(*out, rank).unionByName(scored.where(~high).select(*out, F.lit(None).cast("long").alias("rank")))


NEW = ["n_words", "n_features", "weight", "score", "rank"]


def op13_sql(buckets: int = BUCKETS, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> str:
    """DuckDB SQL of op13's rows; CRC-32 is computed bit by bit, once for each distinct feature."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = lambda t: f"regexp_extract_all(translate(coalesce({t}, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = "flatten([w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2]), list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])])"
    bits = ", ".join(["-1"] * 8)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {words('text')} AS w FROM documents),
    f AS MATERIALIZED (SELECT row_no, unnest({runs}) AS feature FROM d),
    g AS MATERIALIZED (SELECT unnest({runs}) AS feature FROM (SELECT {words('text')} AS w FROM benchmark)),
    one AS (SELECT DISTINCT feature FROM (SELECT feature FROM f UNION ALL SELECT feature FROM g)),
    c AS MATERIALIZED (
      SELECT feature, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(strlen(feature)),
          lambda i: [CAST('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) AS BIGINT), {bits}]))),
        lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % {buckets} AS bucket FROM one
    ), raw AS (SELECT bucket, count(*) AS n FROM f JOIN c USING (feature) GROUP BY bucket),
    target AS (SELECT bucket, count(*) AS n FROM g JOIN c USING (feature) GROUP BY bucket),
    total AS (SELECT (SELECT count(*) FROM f) AS s, (SELECT count(*) FROM g) AS t),
    gain AS (
      SELECT raw.bucket, CAST(floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (s + {buckets}) / ((raw.n + 1)::DOUBLE * (t + {buckets})))) AS BIGINT) AS gain
      FROM raw LEFT JOIN target ON target.bucket = raw.bucket, total
    ), summed AS (SELECT row_no, count(*) AS n_features, sum(gain) AS weight FROM f JOIN c USING (feature) JOIN gain USING (bucket) GROUP BY row_no),
    scored AS (
      SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN summed USING (row_no)
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY n_words >= {least_words} ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) FILTER (WHERE n_words >= {least_words}) OVER () * {share[0]} // {share[1]} AS k FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {least_words} AND place <= k THEN place END AS rank FROM ranked
    """
