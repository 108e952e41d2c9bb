"""Document fingerprints from improbable features.

Every run of ``size`` bytes of a text is a window with an entropy.  How rare an
entropy is, is counted over the windows of all documents.  Of each ``size``
consecutive windows the one of the rarest entropy wins (the leftmost of equals);
windows that win often enough are the text's features.  They go, in order, into
Bloom filters of 2,048 bits, 160 features to a filter: the fingerprint is the
chain of filters.  Two fingerprints are compared filter by filter, by the bits
they share beyond those shared by chance.

``size`` is 32 for texts of 256 bytes or more, and halves with the length below
that, down to 4, so that short texts have several features too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import mix, row_order, shuffle_parts, slices, text_slices, written

SIZES = (4, 8, 16, 32)
LEVELS = 1001
TRIVIAL = 100  # levels of entropy that are no feature while a text has others
BITS, PER_FILTER, HASHES = 2048, 160, 5
BEYOND = 4.0  # standard errors over chance from which on shared bits count
LANES = 4096


def size_of(n_bytes: np.ndarray) -> np.ndarray:
    """Window size of texts: the greatest of ``SIZES`` of which the text has eight, or the least."""
    return np.array(SIZES)[np.searchsorted(8 * np.array(SIZES[1:]), n_bytes, side="right")]


def _weights(size: int) -> np.ndarray:
    """c * log2(c) of each count up to ``size``, in 2**-16; whole numbers, so that sums are exact."""
    c = np.arange(size + 1)
    return np.round(c * np.log2(np.maximum(c, 1)) * 65_536).astype(np.int64)


def entropy_levels(data: np.ndarray, size: int) -> np.ndarray:
    """Entropy of each window of ``size`` bytes, in thousandths of the greatest one.

    The bytes are cut into stretches that are gone through side by side, a byte
    of each at a time, with counts of the bytes in the window for each.
    """
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    f = _weights(size)
    more = np.diff(f)
    lanes = min(LANES, n)
    stretch = -(-n // lanes)
    padded = np.concatenate((data, np.zeros(lanes * stretch + size - len(data), np.uint8)))
    columns = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, stretch + size)[::stretch][:lanes].T).astype(np.int32)
    columns += (np.arange(lanes) * 256).astype(np.int32)
    counts, total, out = np.zeros(lanes * 256, np.int16), np.zeros(lanes, np.int64), np.empty((stretch, lanes), np.int64)
    for t in range(stretch + size - 1):
        at = columns[t]
        c = counts[at]
        total += more[c]
        counts[at] = c + 1
        if t >= size - 1:
            out[t - size + 1] = total
            at = columns[t - size + 1]
            c = counts[at] - 1
            total -= more[c]
            counts[at] = c
    return (LEVELS - 1) - out.T.reshape(-1)[:n] * (LEVELS - 1) // f[size]


def _groups(bodies: Sequence[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size class, numbers of its texts, their starts, their bytes) of texts that have a window."""
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    sizes = size_of(lengths)
    for k, size in enumerate(SIZES):
        at = np.flatnonzero((sizes == size) & (lengths >= size))
        if len(at):
            yield k, at, np.concatenate(([0], np.cumsum(lengths[at]))), np.frombuffer(b"".join([bodies[i] for i in at]), np.uint8)


def _begins(starts: np.ndarray, run: int) -> np.ndarray:
    """At which of the places does a run of ``run`` places begin that stays in its text?"""
    ok = np.zeros(starts[-1] + 1, np.int64)
    has = np.diff(starts) >= run
    np.add.at(ok, starts[:-1][has], 1)
    np.add.at(ok, starts[1:][has] - run + 1, -1)
    return np.cumsum(ok)[:-1] > 0


def level_counts(texts: DataFrame) -> np.ndarray:
    """Windows of each size class and level in all ``texts`` (one column)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SIZES), LEVELS), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                for k, _, starts, data in _groups(_bodies(part.column(0))):
                    levels = entropy_levels(data, SIZES[k])
                    total[k] += np.bincount(levels[_begins(starts, SIZES[k])[: len(levels)]], minlength=LEVELS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], names=["level", "n"])

    out = np.zeros(len(SIZES) * LEVELS, np.int64)
    for r in texts.toDF("text").mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():  # a row for each class and level
        out[r["level"]] = r["n"]
    return out.reshape(len(SIZES), LEVELS)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each level in its size class, the rarest first; trivial levels last, ties to the lower level."""
    levels = np.arange(LEVELS)
    ranks = np.empty_like(counts)
    for k, n in enumerate(counts):
        ranks[k][np.lexsort((levels, n, levels < TRIVIAL))] = levels
    return ranks


def _bodies(texts: pa.Array) -> list[bytes]:
    return pc.fill_null(texts, "").cast(pa.binary()).to_pylist()


def _selected(data: np.ndarray, starts: np.ndarray, size: int, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows that are features, in order."""
    inside = _begins(starts, size)
    levels = entropy_levels(data, size)
    key = np.full(len(data), np.iinfo(np.int64).max)
    key[: len(levels)] = ranks[levels] << 32 | np.arange(len(levels))
    least, run = key, 1
    while run < size:
        least = np.minimum(least[: len(least) - run], least[run:])
        run *= 2
    contest = _begins(starts, 2 * size - 1)[: len(least)]
    won = np.bincount(least[contest] & 0xFFFFFFFF, minlength=len(data))
    own = np.diff(starts) < 2 * size - 1  # fewer windows than a contest has: one contest
    for a, b in zip(starts[:-1][own], starts[1:][own]):
        won[np.argmin(key[a : b - size + 1]) + a] = 1
    chosen = (won >= size // 4) & inside
    none = np.flatnonzero(np.add.reduceat(chosen, starts[:-1], dtype=np.int64) == 0)
    for a, b in zip(starts[:-1][none], starts[1:][none]):
        chosen[np.argmax(won[a:b]) + a] = True  # the first of those that won most
    return np.flatnonzero(chosen)


def digests(bodies: Sequence[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The fingerprint of each text: an array of filters of 256 bytes. An empty text has no filter."""
    out: list[np.ndarray] = [np.zeros((0, BITS // 8), np.uint8)] * len(bodies)
    for i, b in enumerate(bodies):
        if 0 < len(b) < SIZES[0]:  # the whole text is its feature
            out[i] = _filters(np.zeros(1, np.int64), mix(np.array([int.from_bytes(b, "little") | len(b) << 32], np.uint64)), 1)[0]
    for k, at, starts, data in _groups(bodies):
        size = SIZES[k]
        place = _selected(data, starts, size, ranks[k])
        windows = np.lib.stride_tricks.sliding_window_view(data, size)[place]
        h = np.full(len(place), size, np.uint64)
        for word in np.ascontiguousarray(windows).view(np.uint32 if size < 8 else np.uint64).T.astype(np.uint64):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word)
        text = np.searchsorted(starts, place, side="right") - 1
        first = np.lexsort((place, h, text))
        again = np.concatenate(([False], (text[first][1:] == text[first][:-1]) & (h[first][1:] == h[first][:-1])))
        kept = np.sort(first[~again])
        for i, filters in zip(at, _filters(text[kept], h[kept], len(at))):
            out[i] = filters
    return out


def _filters(text: np.ndarray, h: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """Filters of each text, from the hashes of its features in order."""
    counts = np.bincount(text, minlength=n_texts)
    n_filters = -(-counts // PER_FILTER)
    begin = np.concatenate(([0], np.cumsum(n_filters)))
    rank = np.arange(len(text)) - np.concatenate(([0], np.cumsum(counts)))[text]
    of = begin[text] + rank // PER_FILTER
    bits = np.zeros((begin[-1], BITS), bool)
    for j in range(HASHES):
        bits[of, (h >> np.uint64(11 * j)).astype(np.int64) % BITS] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a:b] for a, b in zip(begin[:-1], begin[1:])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike two fingerprints are, from 0 to 1.

    Each filter of the shorter chain (of equal ones that with fewer bits) takes
    its best partner in the other: the bits shared beyond chance, over the most
    that could be; nothing within ``BEYOND`` standard errors of chance.  The
    mean is weighted by the bits of the filters.  Two empty fingerprints are
    alike, an empty one and another are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if np.array_equal(a, b):
        return 1.0
    a, b = sorted((np.ascontiguousarray(x).view(np.uint64) for x in (a, b)), key=lambda x: (len(x), int(np.bitwise_count(x).sum()), x.tobytes()))
    in_a, in_b = (np.bitwise_count(x).sum(axis=1).astype(float) for x in (a, b))
    best = np.zeros(len(a))
    for i, (f, n) in enumerate(zip(a, in_a)):
        shared = np.bitwise_count(f & b).sum(axis=1).astype(float)
        least, most = np.minimum(n, in_b), np.maximum(n, in_b)
        chance = n * in_b / BITS
        error = np.sqrt(chance * (1 - most / BITS))
        best[i] = np.where(shared > chance + BEYOND * error, (shared - chance) / np.maximum(least - chance, 1e-9), 0.0).max()
    return float(np.clip((best * in_a).sum() / in_a.sum(), 0.0, 1.0))


def fingerprint(docs: DataFrame, ranks: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint binary) of each row, in any order; ``ranks`` by default those of ``docs`` themselves."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    of = rarity(level_counts(rows.select("text"))) if ranks is None else ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = pa.array([x.tobytes() for x in digests(_bodies(part.column(1)), of)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pc.utf8_length(part.column(1)).cast(pa.int64()), found], names=["doc_id", "n_chars", "fingerprint"])

    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint binary")


PAIR = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following`` (or all of them)."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _pairs(rows: list[tuple], ranks: np.ndarray) -> list[list]:
    """Columns of PAIR for all but the last of ``rows`` (doc_id, text, fingerprint), each with the next one."""
    other = [edited(a[1], b[1]).encode() for a, b in zip(rows, rows[1:])]
    found = digests(other, ranks)
    out: list[list] = [[] for _ in range(7)]
    for (i, t, f), (_, _, nxt), body, e in zip(rows, rows[1:], other, found):
        for column, value in zip(out, (i, len(t), hashlib.sha256(body).hexdigest(), f.tobytes(), e.tobytes(), likeness(f, e), likeness(f, nxt))):
            column.append(value)
    return out


def with_edits(docs: DataFrame, ranks: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts (``edited``, by the next document in the order of doc_id).

    Columns: those of ``PAIR``; after the last document comes the first.  A null
    text counts as empty; null ids come last, rows of equal ids in the order of
    a hash of their texts.  Equal rows are dealt out and each has a row of its
    own.  An empty table gives an empty result.

    The texts are dealt out by ranges of the order, and each task goes through
    its range with one document in hand.  The last document of a range is
    completed by the first of the next range: two texts a range, joined by the
    range's number.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = docs.select(row_order(doc_id).alias("ord"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("th"), body, F.monotonically_increasing_id().alias("arrived"))
    of = rarity(level_counts(rows.select("text"))) if ranks is None else ranks
    keys = ["ord", "th", "arrived"]
    dealt = rows.repartitionByRange(shuffle_parts(spark), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    edge = ", part long, at long, text string"  # at: 0 a finished row, 1 a range's first document, 2 its last

    def as_batch(columns: list[list], part: int | None, at: int, texts: list | None = None) -> pa.RecordBatch:
        n = len(columns[0])
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
        values = [*columns, [part] * n, [at] * n, texts or [None] * n]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[*[c.split()[0] for c in (PAIR + edge).split(", ")]])

    def open_row(row: tuple, part: int, at: int) -> pa.RecordBatch:
        return as_batch([[row[0]], [len(row[1])], [None], [row[2].tobytes()], [None], [None], [None]], part, at, [row[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in text_slices(batch, "text", 1 << 20):
                texts = piece.column(1).to_pylist()
                here = list(zip(piece.column(0).to_pylist(), texts, digests([t.encode() for t in texts], of)))
                if last is None:
                    yield open_row(here[0], part, 1)
                else:
                    here.insert(0, last)
                last = here[-1]
                if len(here) > 1:
                    yield as_batch(_pairs(here, of), part, 0)
        if last is not None:
            yield open_row(last, part, 2)

    table = written(dealt.mapInArrow(run, PAIR + edge), "edits", "zstd")  # filters are mostly zeros
    ranges = [r["part"] for r in table.where("at = 1").select("part").orderBy("part").collect()]  # a row for each range
    following = spark.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1])), "part long, next long")
    first = table.where("at = 1").select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    ends = table.where("at = 2").select("part", "doc_id", "text", "fingerprint").join(following, "part").join(first, "next").drop("part", "next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = lambda x: np.frombuffer(x, np.uint8).reshape(-1, BITS // 8)
        for batch in batches:
            for a, b in slices(np.ones(batch.num_rows, np.int64), 1):
                r = batch.slice(a, b - a).to_pylist()[0]
                two = [(r["doc_id"], r["text"], filters(r["fingerprint"])), (None, r["next_text"], filters(r["next_fingerprint"]))]
                yield as_batch(_pairs(two, of), None, 0).select(range(7))

    names = [c.split()[0] for c in PAIR.split(", ")]
    return table.where("at = 0").select(*names).unionByName(ends.mapInArrow(finish, PAIR))
