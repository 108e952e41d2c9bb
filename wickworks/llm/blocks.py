"""Substring dedup over words by fixed-block anchors.

Every text is cut into reference blocks of ``block`` words that don't overlap.
Any window of ``2 * block`` words holds a whole block, so of two equal windows
the later one, probing with each of its runs of ``block`` words, hits a block
of the earlier one.  Hits are extended to all windows around them; a window
whose words begin earlier too is repeated, and repeated windows that overlap
make up the maximal repeats, whose words go.

Probes and windows are dealt by their hash, packed to a few bytes each.  What
is equal inside one stretch of input is settled there and sent once, so that a
passage which many documents share doesn't gather in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import NULL_LAST, inside, keyed_texts, shuffle_parts, spans_of, text_slices, window_hashes, word_hashes
from wickworks.llm.packed import HOMING, PACKED, Positions, Stretch, at_home, by_text, homing, joined, numbers, rows_of, unpack

WINDOW = 20
STRETCH_BYTES = 6 << 20
PART_BYTES = 12 << 20
SENT, SETTLED = 0, 1


def _parts(texts: DataFrame) -> int:
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(shuffle_parts(texts.sparkSession), -(-total // PART_BYTES))


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order by key, number of the group of each in that order)."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return order, np.cumsum(new)


def shared(p: Positions, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Which positions are in a group of equal keys with another one and a block's begin; and the group's block to send."""
    if not len(p.at):
        return np.zeros(0, bool), np.zeros(0, bool)
    order, group = _groups(p.keys)
    is_block = p.at[order] % block == 0
    size = np.bincount(group)
    blocks = np.bincount(group, is_block)
    hit, one = np.zeros(len(order), bool), np.zeros(len(order), bool)
    hit[order] = (size[group] > 1) & (blocks[group] > 0)
    at = np.flatnonzero(is_block)
    first = at[np.concatenate(([True], group[at[1:]] != group[at[:-1]]))] if len(at) else at
    one[order[first]] = True
    return hit, one


def later(p: Positions) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal one at a smaller (ord, place); and which are the least of theirs."""
    if not len(p.at):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((p.at, p.ord, *p.keys[::-1]))
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in p.keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    low = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    after = (p.ord[order] > p.ord[low]) | (p.ord[order] == p.ord[low]) & (p.at[order] > p.at[low])
    out = np.zeros(len(order), bool)
    out[order] = after
    return out, ~out


def _stretches(batches: Iterator[pa.RecordBatch], find, parts: int) -> Iterator[tuple[Stretch, Positions]]:
    """Stretches of input of bounded size, with the positions that ``find`` sees in slices of their texts."""
    held, ords, ths, n_docs, size = [], [], [], 0, 0

    def whole() -> tuple[Stretch, Positions]:
        p, ord_ = joined(held), np.concatenate(ords)
        p.ord = ord_[p.doc]
        return Stretch(ord_, np.concatenate(ths), parts), p

    for batch in batches:
        names = batch.schema.names
        for part in text_slices(batch, "text"):
            p = find(part)
            p.doc += np.int32(n_docs)
            held.append(p)
            ords.append(part.column(names.index("ord")).to_numpy())
            ths.append(part.column(names.index("th")).to_numpy())
            n_docs += part.num_rows
            size += part.column(names.index("text")).nbytes
            if size >= STRETCH_BYTES:
                yield whole()
                held, ords, ths, n_docs, size = [], [], [], 0, 0
    if held:
        yield whole()


def _probes(texts: DataFrame, block: int, parts: int) -> DataFrame:
    def find(part: pa.RecordBatch) -> Positions:
        starts, h = word_hashes(part.column(2))
        ok = np.flatnonzero(inside(starts, block))
        row = np.searchsorted(starts, ok, side="right") - 1
        return Positions(row.astype(np.int32), (ok - starts[row]).astype(np.int32), [window_hashes(h, block)[ok]])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stretch, p in _stretches(batches, find, parts):
            hit, one = shared(p, block)
            sent = p.take(np.flatnonzero(~hit | one))
            key = sent.keys[0]
            sent.keys, sent.ord = [(key & np.uint64(0xFFFFFFFF)).astype(np.uint32)], None
            stretch.send(SENT, sent, key)
            stretch.settle(SETTLED, p.take(np.flatnonzero(hit)))
            yield stretch.batch()

    return texts.mapInArrow(probe, PACKED)


def _settle(dealt: DataFrame, verdict) -> DataFrame:
    """(ord, th, found): texts with their settled places, and those of the others that ``verdict`` picks in each part."""

    def settle(table: pa.Table) -> pa.Table:
        rows = list(rows_of(table))
        sent = [unpack(b, s) for s, k, b in rows if k == SENT]
        found = []
        if sent:
            p = joined(sent)
            found.append((SETTLED, p.take(np.flatnonzero(verdict(p)), bare=True)))
        return homing(found, [r for r in rows if r[1] != SENT])

    return by_text(at_home(dealt.groupBy("part").applyInArrow(settle, HOMING), {"at": (SETTLED,)}), ["at"])


def places(found: list[dict] | None) -> np.ndarray:
    """The places found in a text, each once, in order."""
    return np.unique(numbers([x["at"] for x in found or []])).astype(np.int64)


def _windows(hits: DataFrame, texts: DataFrame, window: int, block: int, parts: int) -> DataFrame:
    def find(part: pa.RecordBatch) -> Positions:
        names = part.schema.names
        starts, h = word_hashes(part.column(names.index("text")))
        near = np.zeros(len(h) + 1, np.int64)
        for start, found in zip(starts.tolist(), part.column(names.index("found")).to_pylist()):
            at = places(found)
            np.add.at(near, start + np.maximum(at - (window - block), 0), 1)
            np.add.at(near, start + at + 1, -1)
        ok = np.flatnonzero((np.cumsum(near)[: max(0, len(h) - window + 1)] > 0) & inside(starts, window))
        row = np.searchsorted(starts, ok, side="right") - 1
        return Positions(row.astype(np.int32), (ok - starts[row]).astype(np.int32), [window_hashes(h, window)[ok], (window_hashes(h, window, 0xC2B2AE3D27D4EB4F)[ok] >> np.uint64(32)).astype(np.uint32)])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stretch, p in _stretches(batches, find, parts):
            gone, least = later(p)
            sent = p.take(np.flatnonzero(least))
            stretch.send(SENT, sent, sent.keys[0])
            stretch.settle(SETTLED, p.take(np.flatnonzero(gone)))
            yield stretch.batch()

    return hits.join(texts, ["ord", "th"]).mapInArrow(extend, PACKED)


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(ord, th, found): begins of the windows in each text (ord, th, text) whose words begin earlier too (see ``places``)."""
    block, parts = window // 2, _parts(texts)
    hits = _settle(_probes(texts, block, parts), lambda p: shared(p, block)[0])
    return _settle(_windows(hits, texts, window, block, parts), lambda p: later(p)[0])


def dedup_substrings(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, n_words, n_removed, spans: what is left of each row's text.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are.  A word goes if a
    window of ``window`` words around it also begins earlier: in a smaller
    doc_id (null is last), or earlier in the same document, on the input.  text:
    the kept words joined by one space; spans: [begin, end) of the runs of words
    that went.  A null text has no words.  Rows with equal doc_id count as one
    document, so a repeated row isn't an earlier copy of itself.
    """
    texts = keyed_texts(docs, doc_id, text)
    gone = repeated_windows(texts, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                names = part.schema.names
                left, counts, removed, spans = [], [], [], []
                for body, found in zip(part.column(names.index("text")).to_pylist(), part.column(names.index("found")).to_pylist()):
                    words = body.encode().split()
                    at = places(found)
                    begin, end = spans_of(at, at + window)
                    keep, last = [], 0
                    for a, b in zip(begin.tolist(), end.tolist()):
                        keep += words[last:a]
                        last = b
                    keep += words[last:]
                    left.append(b" ".join(keep).decode())
                    counts.append(len(words))
                    removed.append(len(words) - len(keep))
                    spans.append(np.stack((begin, end), axis=1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(names.index("ord")), pa.array(left, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                    names=["ord", "text", "n_words", "n_removed", "spans"],
                )

    left = texts.join(gone, ["ord", "th"], "left").select("ord", "text", "found").mapInArrow(cut, "ord long, text string, n_words long, n_removed long, spans array<array<long>>")
    return left.select(F.when(F.col("ord") != F.lit(NULL_LAST), F.col("ord")).alias("doc_id"), "text", "n_words", "n_removed", "spans")


def op9_sql(window: int = WINDOW) -> str:
    """DuckDB SQL of op9's rows."""
    return f"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), g AS (
      SELECT doc_id, i, md5(array_to_string(words[i:i + {window - 1}], ' ')) AS h FROM w, unnest(range(1, len(words) - {window - 2})) AS u(i) WHERE len(words) >= {window}
    ), later AS (
      SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM g) WHERE n > 1
    ), gone AS (
      SELECT DISTINCT doc_id, i + j AS i FROM later, unnest(range({window})) AS u(j)
    ), each AS (
      SELECT doc_id, i, words[i] AS word FROM w, unnest(range(1, len(words) + 1)) AS u(i)
    ), kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """
