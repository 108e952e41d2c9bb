"""Helpers shared by the training-data operators.

A row is known by ``ROW_KEY``: its doc_id with null last, and a hash of its
text.  Rows equal in both are copies of one another and get equal results, so
a repeated row needs no further identity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.session import scratch_path

NULL_LAST = 2**63 - 1
# Bytes of text that one round of vector operations takes, unless one text is longer.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_order(doc_id: str = "doc_id") -> Column:
    """doc_id as a sort key, null last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_LAST))


def keyed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(ord, th, text): the row key and the whole text, null as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(row_order(doc_id).alias("ord"), F.xxhash64(t).alias("th"), t.alias("text"))


def hidden(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ..., so that no name of theirs is in the way."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def shown(df: DataFrame, names: list[str], *new: str) -> DataFrame:
    """Give ``hidden`` columns their names back, and add the columns ``new``, which replace those of their names."""
    taken = {n.lower() for n in new}
    return df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in taken], *new)


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` units together; a longer row is alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Sub-batches of bounded text size."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    for a, b in slices(sizes.to_numpy(zero_copy_only=False), limit):
        yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (start of each text in words, words)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    words, parent = pc.filter(words, full), pc.filter(parent, full).to_numpy(zero_copy_only=False)
    counts = np.bincount(parent, minlength=len(texts)) if len(parent) else np.zeros(len(texts), np.int64)
    return np.concatenate(([0], np.cumsum(counts))).astype(np.int64), words


def word_hashes(texts: pa.Array, plain: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(start of each text in words, 64-bit hash of each word).

    ``plain``: words are lower-cased and cut down to letters and digits; those
    without any are left out.
    """
    starts, words = split_words(texts)
    if not len(words):
        return starts, np.zeros(0, np.uint64)
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    if plain:
        names = pc.replace_substring_regex(pc.utf8_lower(names), r"[^\p{L}\p{N}]+", "")
    hashes = pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False)[codes]
    if plain:
        full = pc.greater(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)[codes]
        if not full.all():
            starts = np.concatenate(([0], np.cumsum(full)))[starts]
            hashes = hashes[full]
    return starts, hashes


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, k: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes; no care for text ends."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    m, g, out = np.uint64(seed | 1), mix(h ^ np.uint64(seed >> 7)), np.zeros(n, np.uint64)
    for j in range(k):
        out = out * m + g[j : j + n]
    return mix(out)


def inside(starts: np.ndarray, k: int) -> np.ndarray:
    """For each position where a run of ``k`` words may begin: does it stay in its text?"""
    n = int(starts[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(int(starts[-1]), bool)
    for j in range(1, k):  # the last k-1 places of each text
        at = starts[1:] - j
        ok[at[at >= starts[:-1]]] = False
    return ok[:n]


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def spans_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals, as maximal runs in order."""
    if not len(starts):
        return starts, ends
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))
    return s[new], e[last]
