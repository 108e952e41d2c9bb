"""Benchmark decontamination by greedy string tiling.

Token windows shared with a benchmark item seed the search.  Where the seeds
could cover enough of an item, running Karp-Rabin greedy string tiling marks
the longest common runs first, each token once, down to the seed length.  The
share of the item's tokens under tiles decides; the order of the tiles in the
document doesn't matter, so reordered passages are found too.

Tokens are white-space words, lower-cased, with only letters and digits kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import hidden, inside, remove, shown, text_slices, window_hashes, word_hashes
from wickworks.session import scratch_path

SEED = 5
COVERAGE = 0.5
BLOCK_TOKENS = 1_000_000


BASE = 0x100000001B3
INVERSE = pow(BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


def _windows(tokens: np.ndarray, marked: np.ndarray, size: int) -> tuple[list[int], list[int]]:
    """(places, hashes) of the windows of ``size`` without a marked token, by a running hash."""
    if len(tokens) < size:
        return [], []
    free = np.concatenate(([0], np.cumsum(marked)))
    at = np.flatnonzero(free[size:] == free[:-size])
    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(tokens * _powers(BASE, len(tokens))[:-1])))
    return at.tolist(), ((sums[at + size] - sums[at]) * _powers(INVERSE, len(tokens))[at]).tolist()


def greedy_tiles(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, length) of two token arrays.

    Longest matches are marked first; a match that overlaps a marked token is
    tried again shorter.  No tile is shorter than ``shortest``.
    """
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(shortest, min(len(item), len(text)) // 2)
    while True:
        places = defaultdict(list)
        for a, h in zip(*_windows(item, in_item, size)):
            places[h].append(a)
        matches = []
        for b, h in zip(*_windows(text, in_text, size)):
            for a in places.get(h, ()):
                if a and b and not in_item[a - 1] and not in_text[b - 1] and item[a - 1] == text[b - 1]:
                    continue  # part of a match that began earlier
                n = 0
                while a + n < len(item) and b + n < len(text) and not in_item[a + n] and not in_text[b + n] and item[a + n] == text[b + n]:
                    n += 1
                if n >= size:
                    matches.append((n, a, b))
        occluded = False
        for n, a, b in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if in_item[a : a + n].any() or in_text[b : b + n].any():
                occluded = True  # what is left of it is found by another scan
                continue
            in_item[a : a + n] = in_text[b : b + n] = True
            tiles.append((a, b, n))
        if occluded:
            continue
        if size == shortest:
            return tiles
        size = max(shortest, size // 2)


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, ids: list[int], tokens: list[np.ndarray], seed: int):
        self.ids, self.tokens, self.seed = ids, tokens, seed
        keys = [window_hashes(t, seed) for t in tokens]
        key = np.concatenate([*keys, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([*[np.arange(len(k)) for k in keys], np.zeros(0, np.int64)])
        order = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.last = np.append(self.first[1:], len(key))
        self.item, self.place = item[order], place[order].astype(np.int64)

    def hits(self, windows: np.ndarray) -> np.ndarray:
        """Number of each window's seed, -1 if it is none."""
        if not len(self.keys):
            return np.full(len(windows), -1)
        at = np.minimum(np.searchsorted(self.keys, windows), len(self.keys) - 1)
        return np.where(self.keys[at] == windows, at, -1)

    def covered(self, tokens: np.ndarray, hits: np.ndarray, least: float) -> list[tuple[int, float]]:
        """(item number, share of its tokens under tiles) where that is ``least`` or more."""
        seeds = np.unique(hits)
        at = np.concatenate([np.arange(a, b) for a, b in zip(self.first[seeds], self.last[seeds])])
        item, place = self.item[at], self.place[at]
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        # no tile reaches beyond the seeds: an upper bound of the share
        gap = np.minimum(np.diff(place, append=0), self.seed)
        gap[np.append(item[1:] != item[:-1], True)] = self.seed
        numbers, begin = np.unique(item, return_index=True)
        out = []
        for number, most in zip(numbers.tolist(), np.add.reduceat(gap, begin).tolist()):
            mine = self.tokens[number]
            if most >= least * len(mine):
                share = sum(n for _, _, n in greedy_tiles(mine, tokens, self.seed)) / len(mine)
                if share >= least:
                    out.append((number, share))
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, seed: int, block_tokens: int) -> Iterator[Index]:
    """Indexes of parts of the benchmark of about ``block_tokens`` tokens each."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-total // block_tokens))
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy(F.col("item_id").asc_nulls_last(), "text").collect()
        starts, hashes = word_hashes(pa.array([r["text"] for r in rows], pa.string()), plain=True)
        long_enough = [i for i in range(len(rows)) if starts[i + 1] - starts[i] >= seed]
        if long_enough:
            yield Index([rows[i]["item_id"] for i in long_enough], [hashes[starts[i] : starts[i + 1]] for i in long_enough], seed)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text", seed: int = SEED, coverage: float = COVERAGE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Add ``item_ids`` (the benchmark items that a document contains, in order),
    ``item_id`` and ``coverage`` (the best covered one; ties go to the first) and
    ``contaminated`` to the columns ``keep`` (all by default).

    An item is contained if tiles of ``seed`` tokens or more cover the share
    ``coverage`` of its tokens.  Items of fewer than ``seed`` tokens, null or
    empty ones are not tested; null or empty texts contain nothing.  Items with
    null id are reported in ``coverage`` and ``contaminated`` only.

    The benchmark is a stated query set: it goes to the executors in blocks of
    about ``block_tokens`` tokens, each one narrow pass over the documents.
    Between two passes the rows are written as a table and the block before is
    dropped from the executors, so that they and the driver hold one block's
    index at a time, however large the benchmark; of the tables only the last is
    kept.  Nothing is shuffled.  Columns of the new names are replaced.
    """
    keep = docs.columns if keep is None else keep
    n_keep = len(keep)
    rows = hidden(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")))
    new = {"item_ids": F.lit(None).cast("array<bigint>"), "item_id": F.lit(None).cast("bigint"), "coverage": F.lit(0.0)}
    out = rows.select(*rows.columns[:n_keep], *[c.alias(n) for n, c in new.items()], F.col(f"c{n_keep}").alias("body"))
    sc = docs.sparkSession.sparkContext
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    shared, before = None, None
    for index in _blocks(benchmark, item_id, item_text, seed, block_tokens):
        if shared is not None:
            path = scratch_path(docs.sparkSession, "tiled-blocks")
            out.write.parquet(path)
            out = docs.sparkSession.read.schema(out.schema).parquet(path)
            shared.destroy()
            if before is not None:
                remove(docs.sparkSession, before)
            before = path
        shared = sc.broadcast(index)

        def tile(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in text_slices(batch, "body", 1 << 22):
                    starts, hashes = word_hashes(part.column(n_keep + 3), plain=True)
                    hits = index.hits(window_hashes(hashes, seed))
                    hits[~inside(starts, seed)] = -1
                    at = np.flatnonzero(hits >= 0)
                    row = np.searchsorted(starts, at, side="right") - 1
                    found: dict[int, list[tuple[int, float]]] = {}
                    for r in np.unique(row):
                        of = at[row == r]
                        got = index.covered(_near(hashes, starts[r], starts[r + 1], of, seed), hits[of], coverage)
                        if got:
                            found[int(r)] = got
                    if found:
                        part = _merge(part, found, index.ids, n_keep)
                    yield part

        out = out.mapInArrow(tile, fields)
    items = F.coalesce(F.col("item_ids"), F.expr("array()").cast("array<bigint>"))
    return shown(out.withColumn("item_ids", items).withColumn("contaminated", F.col("coverage") > 0), keep, *new, "contaminated")


def _near(hashes: np.ndarray, start: int, end: int, at: np.ndarray, seed: int) -> np.ndarray:
    """The tokens under the hits; a run that doesn't touch the next is followed by a token that matches nothing."""
    covered = np.zeros(end - start + 1, bool)
    for j in range(seed):
        covered[at - start + j] = True
    tokens = np.where(covered[:-1], hashes[start:end], np.uint64(0))
    return tokens[covered[:-1] | np.concatenate(([False], covered[:-2]))]


def _merge(part: pa.RecordBatch, found: dict[int, list[tuple[int, float]]], ids: list, n_keep: int) -> pa.RecordBatch:
    lists, best, cover = (part.column(n_keep + i).to_pylist() for i in range(3))
    for r, got in found.items():
        lists[r] = sorted({*(lists[r] or []), *(ids[i] for i, _ in got if ids[i] is not None)})
        i, share = min(got, key=lambda g: (-g[1], ids[g[0]] is None, ids[g[0]] or 0))
        if share > cover[r] or share == cover[r] and (best[r] is None or ids[i] is not None and ids[i] < best[r]):
            best[r], cover[r] = ids[i], share
    columns = list(part.columns)
    columns[n_keep], columns[n_keep + 1], columns[n_keep + 2] = pa.array(lists, pa.list_(pa.int64())), pa.array(best, pa.int64()), pa.array(cover, pa.float64())
    return pa.RecordBatch.from_arrays(columns, schema=part.schema)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns kept."""
    rows = hidden(docs)
    found = contamination(rows, benchmark, rows.columns[docs.columns.index("text")], **options)
    return shown(found.where(~F.col("contaminated")), docs.columns)
