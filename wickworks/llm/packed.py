"""Positions in texts, packed for a shuffle.

A task cuts its texts into stretches.  A position is sent as the number of its
text in the stretch and its place there, both as gaps to the one before, so it
costs little more than its key.  What is found out about it goes home to the
stretch, whose table of texts names the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import mix

TABLE = -1
PACKED = "part int, kind int, stretch long, blob binary"
HOMING = "stretch long, kind int, blob binary"


@dataclass
class Positions:
    """``at[i]`` is a place in text ``doc[i]`` of stretch ``stretch[i]``; ``keys`` and, if kept, ``ord`` go along.

    In order of (doc, at) in each stretch.
    """

    doc: np.ndarray
    at: np.ndarray
    keys: list[np.ndarray] = field(default_factory=list)
    ord: np.ndarray | None = None
    stretch: np.ndarray | None = None

    def take(self, index: np.ndarray, bare: bool = False) -> Positions:
        some = lambda x: None if x is None else x[index]
        return Positions(self.doc[index], self.at[index], [] if bare else [k[index] for k in self.keys], None if bare else some(self.ord), some(self.stretch))


def joined(parts: list[Positions]) -> Positions:
    cat = lambda x: None if x[0] is None else np.concatenate(x)
    return Positions(
        cat([p.doc for p in parts]), cat([p.at for p in parts]), [np.concatenate(k) for k in zip(*[p.keys for p in parts])],
        cat([p.ord for p in parts]), cat([p.stretch for p in parts]),
    )


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers by byte planes: the high ones are mostly zero and compress away."""
    return x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _gaps(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = x.astype(np.int32)
    out[1:] -= np.where(first[1:], 0, out[:-1])
    return out


def _blob(p: Positions) -> bytes:
    first = np.concatenate(([True], p.doc[1:] != p.doc[:-1]))
    docs = p.doc[first]
    head = np.array([len(docs), len(p.at), p.ord is not None, *[k.dtype.itemsize for k in p.keys]], np.int64)
    counts = np.diff(np.append(np.flatnonzero(first), len(first)))
    begin = np.zeros(len(docs), bool)
    begin[:1] = True
    parts = [np.int64(len(head)).tobytes(), head.tobytes(), _planes(_gaps(docs, begin)), _planes(counts), b"" if p.ord is None else p.ord[first].tobytes()]
    return b"".join([*parts, _planes(_gaps(p.at, first)), *[k.tobytes() for k in p.keys]])


def unpack(blob: bytes, stretch: int) -> Positions:
    n_head = int(np.frombuffer(blob, np.int64, 1)[0])
    n_docs, n, has_ord, *sizes = np.frombuffer(blob, np.int64, n_head, 8).tolist()
    end = 8 + 8 * n_head

    def read(kind: type, count: int) -> np.ndarray:
        nonlocal end
        out = np.frombuffer(blob, kind, count, end)
        end += out.nbytes
        return out

    def planes(count: int) -> np.ndarray:
        return np.ascontiguousarray(read(np.uint8, 4 * count).reshape(4, count).T).view(np.uint32).ravel().astype(np.int64)

    docs, counts = np.cumsum(planes(n_docs)), planes(n_docs)
    ords = read(np.int64, n_docs) if has_ord else None
    gaps = planes(n)
    sums = np.cumsum(gaps)
    begin = (np.cumsum(counts) - counts)[:n_docs]
    at = sums - np.repeat(sums[begin] - gaps[begin], counts)
    keys = [read({1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[s], n) for s in sizes]
    return Positions(np.repeat(docs.astype(np.int32), counts), at.astype(np.int32), keys, None if ords is None else np.repeat(ords, counts), np.full(n, stretch, np.int64))


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]))
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Number of the part that a 64-bit key belongs to, by its high half."""
    return ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)


class Stretch:
    """Texts (ord, th) of a stretch of input, and the rows of PACKED that it sends."""

    def __init__(self, ord_: np.ndarray, th: np.ndarray, parts: int):
        self.ord, self.th, self.parts = ord_, th, parts
        place = np.arange(len(th), dtype=np.uint64)
        self.id = int(np.add.reduce(mix(mix(th.view(np.uint64) + place) ^ ord_.view(np.uint64)), dtype=np.uint64).astype(np.int64)) if len(th) else 0
        self.rows: list[tuple[int, int, int, bytes]] = []

    def send(self, kind: int, p: Positions, key: np.ndarray, more: Callable[[np.ndarray], bytes] | None = None) -> None:
        """Deal positions out by ``key``; ``more`` gives bytes to go along, for their numbers."""
        if not len(p.at):
            return
        part = part_of(key, self.parts)
        order = np.argsort(part, kind="stable")
        for a, b in _runs(part[order]):
            blob = _blob(p.take(order[a:b]))
            if more:
                blob = np.int64(len(blob)).tobytes() + blob + more(order[a:b])
            self.rows.append((int(part[order[a]]), kind, self.id, blob))

    def settle(self, kind: int, p: Positions) -> None:
        """Positions of which nothing is to be found out."""
        if len(p.at):
            self.rows.append((self.id % self.parts, kind, self.id, _blob(p.take(np.arange(len(p.at)), bare=True))))

    def batch(self) -> pa.RecordBatch:
        rows = self.rows
        if rows:
            rows = [*rows, (self.id % self.parts, TABLE, self.id, self.ord.tobytes() + self.th.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["part", "kind", "stretch", "blob"])


def homing(found: list[tuple[int, Positions]], others: list[tuple[int, int, bytes]]) -> pa.Table:
    """Rows of HOMING: positions by kind, and rows (stretch, kind, blob) that only pass."""
    rows = list(others)
    for kind, p in found:
        rows += [(int(p.stretch[a]), kind, _blob(Positions(p.doc[a:b], p.at[a:b], [k[a:b] for k in p.keys]))) for a, b in _runs(p.stretch) if b > a]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["stretch", "kind", "blob"])


def rows_of(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    return zip(table.column("stretch").to_pylist(), table.column("kind").to_pylist(), table.column("blob").to_pylist())


def at_home(homed: DataFrame, kinds: dict[str, tuple[int, ...]], with_keys: tuple[str, ...] = ()) -> DataFrame:
    """(ord, th, one column for each of ``kinds``): per text the places of its kinds as 32-bit numbers,
    and for those of ``with_keys`` a column ``<name>_key`` with their 64- or 32-bit keys."""
    columns = [c for name in kinds for c in ([name, f"{name}_key"] if name in with_keys else [name])]

    def gather(table: pa.Table) -> pa.Table:
        rows = list(rows_of(table))
        texts = next(b for _, k, b in rows if k == TABLE)
        n = len(texts) // 16
        ord_, th = np.frombuffer(texts, np.int64, n), np.frombuffer(texts, np.int64, n, 8 * n)
        found = {}
        for name, of in kinds.items():
            parts = [unpack(b, s) for s, k, b in rows if k in of]
            if parts:
                p = joined(parts)
                found[name] = p.take(np.lexsort((p.at, p.doc)))
        docs = np.unique(np.concatenate([p.doc for p in found.values()] + [np.zeros(0, np.int64)]))
        out = {"ord": pa.array(ord_[docs]), "th": pa.array(th[docs])}
        for name in kinds:
            p = found.get(name)
            cuts = (np.searchsorted(p.doc, docs), np.searchsorted(p.doc, docs, side="right")) if p else None
            out[name] = _lists(cuts, p.at.astype(np.uint32), len(docs)) if p else pa.nulls(len(docs), pa.binary())
            if name in with_keys:
                out[f"{name}_key"] = _lists(cuts, p.keys[0], len(docs)) if p else pa.nulls(len(docs), pa.binary())
        return pa.table(out)

    return homed.groupBy("stretch").applyInArrow(gather, ", ".join(["ord long", "th long", *[f"{c} binary" for c in columns]]))


def _lists(cuts: tuple[np.ndarray, np.ndarray], values: np.ndarray, n: int) -> pa.Array:
    offsets = np.append(cuts[0], cuts[1][-1:] if n else [0]).astype(np.int64) * values.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def numbers(blobs: list[bytes | None] | None, kind: type = np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(b for b in blobs or [] if b), kind)


def by_text(homed: DataFrame, columns: list[str]) -> DataFrame:
    """(ord, th, found: a list of the columns): a row for each text, though its row be repeated in several stretches."""
    return homed.groupBy("ord", "th").agg(F.collect_list(F.struct(*columns)).alias("found"))
