"""Suffix-array dedup over bytes by deep-shallow sorting.

Of all suffixes only anchors are sorted: in every 200 bytes of a text, the
place whose next 40 bytes have the least hash.  Equal strings of 200 bytes have
the same anchor, so a repeat shows as two anchors with equal 40 bytes whose
surroundings agree far enough.  Anchors whose whole surroundings are equal are
settled at once.  The others with the same 40 bytes are sorted, by what follows
them and by what precedes them read backwards: multikey quicksort to a shallow
depth, then a blind trie for each group that still agrees.  The orders' longest
common prefixes tell which strings of 200 bytes are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import NULL_LAST, keyed_texts, mix, shuffle_parts, slices, spans_of, written
from wickworks.llm.packed import HOMING, PACKED, Positions, Stretch, at_home, by_text, homing, joined, numbers, rows_of, unpack

LENGTH = 200
GRAM = 40
BACK = LENGTH - GRAM  # how far before its anchor a string may begin
SHALLOW = 8
STRETCH_BYTES = 8 << 20
PART_BYTES = 16 << 20
PIECE = 900_000  # bytes looked at together; a place in them takes 20 bits
LOCAL_HOT = 512  # different surroundings of 40 bytes in one stretch of input
HOT = 20_000  # ... in one part
PAIRED = 512  # up to so many are compared by a matrix
ANCHORS, FULL, HOT_OPEN, OPEN, CONTEXTS, WINDOWS, COVERED = range(7)


# --- deep-shallow sorting ---------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _at(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """``group`` in the order of its strings, by a trie that holds branching places only.

    A string goes down by the bytes at the branching places alone, is compared
    once with the leaf it comes to, and is hung in where the two part.
    """
    # a node is [depth, {byte: node}] or, as a leaf, a list of equal strings' numbers under depth None
    root: list = [None, [group[0]]]
    for i in group[1:]:
        s, node = strings[i], root
        while node[0] is not None:
            node = node[1].get(_at(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node[1].append(i)
            continue
        parent, key, node = None, None, root
        while node[0] is not None and node[0] < depth:
            parent, key = node, _at(s, node[0])
            node = node[1][key]
        leaf = [None, [i]]
        if node[0] == depth:
            node[1][_at(s, depth)] = leaf
            continue
        fork = [depth, {_at(other, depth): node, _at(s, depth): leaf}]
        if parent is None:
            root = fork
        else:
            parent[1][key] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] is None:
            out += node[1]
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, longest common prefix of each with the next) of strings that agree before ``depth``."""
    if len(strings) == 2:
        order = [0, 1] if strings[0] <= strings[1] else [1, 0]
    else:
        order, deepest, stack = [], depth + shallow, [(list(range(len(strings))), depth)]
        while stack:  # multikey quicksort: three ways by the byte at the depth
            group, d = stack.pop()
            if len(group) < 2:
                order += group
            elif d >= deepest:
                order += blind_trie(strings, group)
            else:
                pivot = _at(strings[group[len(group) // 2]], d)
                less, same, more = [], [], []
                for i in group:
                    c = _at(strings[i], d)
                    (less if c < pivot else more if c > pivot else same).append(i)
                stack.append((more, d))
                stack.append((same, d + 1 if pivot >= 0 else deepest))
                stack.append((less, d))
    return order, [common(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def reach(contexts: list[tuple[bytes, bytes]]) -> list[tuple[int, int] | None]:
    """For each of the (before backwards, after) of anchors alike: least and most
    bytes before the anchor with which a string of 200 bytes around it also stands
    around another; None if there is none.
    """
    n = len(contexts)
    after, right = deep_shallow([a for _, a in contexts], GRAM)
    before, left = deep_shallow([b for b, _ in contexts])
    if n <= PAIRED:
        r, l = _all_common(after, right), _all_common(before, left)
        lo, hi = np.maximum(0, LENGTH - r), np.minimum(BACK, l)
        ok = lo <= hi
        np.fill_diagonal(ok, False)
        least, most = np.where(ok, lo, BACK + 1).min(axis=1), np.where(ok, hi, -1).max(axis=1)
        return [(a, b) if b >= 0 else None for a, b in zip(least.tolist(), most.tolist())]
    least, most = np.full(n, BACK + 1), np.full(n, -1)
    gr, gl = np.zeros(n, np.int64), np.zeros(n, np.int64)
    right_, left_ = np.array(right), np.array(left)
    for k in range(BACK + 1):
        gr[after] = np.concatenate(([0], np.cumsum(right_ < LENGTH - k)))
        gl[before] = np.concatenate(([0], np.cumsum(left_ < k)))
        _, where, count = np.unique(gr * n + gl, return_inverse=True, return_counts=True)
        again = count[where] > 1
        least[again] = np.minimum(least[again], k)
        most[again] = k
    return [(a, b) if b >= 0 else None for a, b in zip(least.tolist(), most.tolist())]


def _all_common(order: list[int], lcp: list[int]) -> np.ndarray:
    """Longest common prefixes of all pairs, from the sorted order and the neighbours' ones."""
    n = len(order)
    out = np.zeros((n, n), np.int64)
    for i in range(n - 1):
        out[i, i + 1 :] = np.minimum.accumulate(lcp[i:])
    out += out.T
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    return out[at][:, at]


# --- anchors ----------------------------------------------------------------


class _Rolling:
    """Hash of each 40 bytes of an array of up to 2**20 bytes."""

    def __init__(self) -> None:
        base = 0x9E3779B97F4A7C15
        n = 1 << 20
        self.table = mix(np.arange(1, 257, dtype=np.uint64))
        self.up = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, np.uint64))))
        self.down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, pow(base, -1, 2**64), np.uint64))))

    def of(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.add.accumulate(self.table[data] * self.up[: len(data)], out=sums[1:])
        n = len(data) - GRAM + 1
        return mix((sums[GRAM:] - sums[:n]) * self.down[:n])


def anchors(data: np.ndarray, starts: np.ndarray, rolling: _Rolling) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of the 40 bytes there) of the anchors of texts that stand one after the other in ``data``."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = rolling.of(data)
    low = np.uint64((1 << 20) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first
    width = 1
    while 2 * width <= BACK + 1:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[BACK + 1 - width : BACK + 1 - width + n])
    inside = np.ones(len(data), bool)
    for end, start in zip(starts[1:].tolist(), starts[:-1].tolist()):
        inside[max(start, end - LENGTH + 1) : end] = False
    mark = np.zeros(len(data), bool)
    mark[(key[inside[:n]] & low).astype(np.int64)] = True
    at = np.flatnonzero(mark)
    return at, h[at]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, start of each text)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, starts = _bytes_of(batch.column(batch.schema.names.index("text")))
    for a, b in slices(np.diff(starts), limit):
        yield batch.slice(a, b - a), data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]


def _found(data: np.ndarray, starts: np.ndarray, rolling: _Rolling) -> tuple[np.ndarray, np.ndarray]:
    """``anchors`` of texts of any length: a very long one is alone, and looked at piece by piece."""
    if len(data) <= PIECE:
        return anchors(data, starts, rolling)
    found = []
    for a in range(0, len(data), PIECE - LENGTH):
        piece = data[a : a + PIECE]
        at, h = anchors(piece, np.array([0, len(piece)]), rolling)
        found.append((at + a, h))
    at, first = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
    return at, np.concatenate([f[1] for f in found])[first]


def _digest(strings: Iterable[bytes]) -> bytes:
    """12 bytes for each."""
    return b"".join([hashlib.blake2b(s, digest_size=12).digest() for s in strings])


def _words_of(digests: bytes) -> list[np.ndarray]:
    digests = np.frombuffer(digests, np.uint8).reshape(-1, 12)
    return [np.ascontiguousarray(digests[:, :8]).view(np.uint64).ravel(), np.ascontiguousarray(digests[:, 8:]).view(np.uint32).ravel()]


def _group(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order by keys, number of each one's group in that order)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return order, np.cumsum(new)


def _sift(stretch: Stretch, p: Positions, local_hot: int) -> pa.RecordBatch:
    """Settle what one stretch of input shows by itself, and deal out the rest.

    keys: hash of the 40 bytes, two of the surroundings.  Sent anchors have a
    fourth key: 1 if their surroundings occur twice, 2 if their 40 bytes have
    too many different surroundings to be sorted together.
    """
    if len(p.at):
        order, cls = _group(p.keys)
        again = np.bincount(cls) > 1
        first = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
        gram = p.keys[0][order[first]]  # of each class; classes of a gram adjoin
        new = np.concatenate(([True], gram[1:] != gram[:-1]))
        of = np.cumsum(new) - 1
        hot = (np.bincount(of) > local_hot)[of]
        stretch.settle(FULL, p.take(np.sort(order[again[cls]])))
        # of a hot gram one word is sent; full or not, the others must be able to find it
        stretch.settle(HOT_OPEN, p.take(np.sort(order[first[hot]])))
        send = ~hot | new
        index, flag = order[first[send]], np.where(hot[send], 2, again[send])
        back = np.argsort(index)
        sent = p.take(index[back])
        sent.keys.append(flag[back].astype(np.uint8))
        stretch.send(ANCHORS, sent, sent.keys[0])
    return stretch.batch()


def _anchor_rows(texts: DataFrame, parts: int, local_hot: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling()
        held, ords, ths, n_docs, size = [], [], [], 0, 0
        for batch in batches:
            for piece, data, starts in _pieces(batch, PIECE):
                at, gram = _found(data, starts, rolling)
                row = np.searchsorted(starts, at, side="right") - 1
                begin, end = np.maximum(starts[row], at - BACK), np.minimum(starts[row + 1], at + LENGTH)
                body = data.tobytes()
                # how much precedes the anchor is part of what must be equal
                around = _digest(bytes((c - a,)) + body[a:b] for a, c, b in zip(begin.tolist(), at.tolist(), end.tolist()))
                held.append(Positions(row + n_docs, at - starts[row], [gram, *_words_of(around)]))
                ords.append(piece.column(0).to_numpy())
                ths.append(piece.column(1).to_numpy())
                n_docs += piece.num_rows
                size += len(data)
                if size >= STRETCH_BYTES:
                    yield _sift(Stretch(np.concatenate(ords), np.concatenate(ths), parts), joined(held), local_hot)
                    held, ords, ths, n_docs, size = [], [], [], 0, 0
        if held:
            yield _sift(Stretch(np.concatenate(ords), np.concatenate(ths), parts), joined(held), local_hot)

    return texts.mapInArrow(find, PACKED)


def _judge_anchors(dealt: DataFrame, most: int) -> DataFrame:
    """(ord, th, full, hot, open, open_key): each text's anchors by what is known; open ones with the hash of their 40 bytes."""

    def judge(table: pa.Table) -> pa.Table:
        rows = list(rows_of(table))
        sent = [unpack(b, s) for s, k, b in rows if k == ANCHORS]
        found = []
        if sent:
            p = joined(sent)
            order, cls = _group(p.keys[:3])
            flag = p.keys[3][order]
            first = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
            gram = p.keys[0][order[first]]
            of = np.cumsum(np.concatenate(([True], gram[1:] != gram[:-1]))) - 1
            n_classes = np.bincount(of)
            most_flag = np.maximum.reduceat(flag, first)
            hot = (np.bincount(of, most_flag == 2) > 0) | (n_classes > most)
            full = (np.bincount(cls) > 1) | (most_flag == 1)
            is_first = np.zeros(len(order), bool)
            is_first[first] = True
            is_open = ~hot[of][cls] & is_first & (n_classes[of][cls] > 1)
            found.append((FULL, p.take(np.sort(order[full[cls] & (flag != 2)]), bare=True)))
            found.append((HOT_OPEN, p.take(np.sort(order[hot[of][cls] & (flag != 2) & is_first]), bare=True)))
            opened = p.take(np.sort(order[is_open]))
            opened.keys = opened.keys[:1]
            found.append((OPEN, opened))
        return homing(found, [r for r in rows if r[1] != ANCHORS])

    homed = dealt.groupBy("part").applyInArrow(judge, HOMING)
    return at_home(homed, {"full": (FULL,), "hot": (HOT_OPEN,), "open": (OPEN,)}, ("open",))


# --- what the anchors have around them ---------------------------------------


def _open_rows(judged: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """The surroundings of open anchors, and the hashes of all strings around hot ones, dealt out."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(batch.schema.names.index("found")).to_pylist()
            weights = [sum(len(x["open"] or b"") + 16 * len(x["hot"] or b"") for x in f) for f in found]
            for a, b in slices(np.array(weights), 1 << 18):  # the surroundings are a hundred times that
                yield _look(batch.slice(a, b - a), found[a:b], parts)

    asked = judged.where("hot IS NOT NULL OR open IS NOT NULL")
    return by_text(asked, ["hot", "open", "open_key"]).join(texts, ["ord", "th"]).mapInArrow(look, PACKED)


def _look(batch: pa.RecordBatch, found: list[list[dict]], parts: int) -> pa.RecordBatch:
    names = batch.schema.names
    stretch = Stretch(*(batch.column(names.index(c)).to_numpy() for c in ("ord", "th")), parts)
    rows, places, grams, before, bodies = [], [], [], [], []
    hot_rows, hot_at, digests = [], [], []
    for i, (text, lists) in enumerate(zip(batch.column(names.index("text")).to_pylist(), found)):
        body = text.encode()
        hot = np.unique(numbers([x["hot"] for x in lists])).astype(np.int64)
        if len(hot):
            near = np.zeros(len(body) + 1, np.int64)
            np.add.at(near, np.maximum(0, hot - BACK), 1)
            np.add.at(near, hot + 1, -1)
            begin = np.flatnonzero(np.cumsum(near)[: max(0, len(body) - LENGTH + 1)] > 0)
            hot_rows.append(np.full(len(begin), i))
            hot_at.append(begin)
            digests.append(_digest(body[a : a + LENGTH] for a in begin.tolist()))
        at, first = np.unique(numbers([x["open"] for x in lists]), return_index=True)
        gram = numbers([x["open_key"] for x in lists], np.uint64)[first]
        for p, g in zip(at.tolist(), gram.tolist()):
            rows.append(i)
            places.append(p)
            grams.append(g)
            before.append(min(p, BACK))
            bodies.append(body[max(0, p - BACK) : p + LENGTH])
    if rows:
        p = Positions(np.array(rows), np.array(places), [np.array(grams, np.uint64)])
        sizes = np.array([before, [len(b) for b in bodies]], np.uint32).T
        stretch.send(CONTEXTS, p, p.keys[0], lambda index: sizes[index].tobytes() + b"".join([bodies[j] for j in index.tolist()]))
    if digests:
        q = Positions(np.concatenate(hot_rows), np.concatenate(hot_at), _words_of(b"".join(digests)))
        order, cls = _group(q.keys)
        again = np.bincount(cls) > 1
        first = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
        back = np.argsort(order[first])
        sent = q.take(order[first][back])
        sent.keys.append(again.astype(np.uint8)[back])
        stretch.send(WINDOWS, sent, sent.keys[0])
        stretch.settle(COVERED, q.take(np.sort(order[again[cls]])))
    return stretch.batch()


def _contexts(blob: bytes, stretch: int) -> tuple[Positions, list[tuple[bytes, bytes]]]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    p = unpack(blob[8 : 8 + n], stretch)
    sizes = np.frombuffer(blob, np.uint32, 2 * len(p.at), 8 + n).reshape(-1, 2)
    at, out = 8 + n + sizes.nbytes, []
    for before, size in sizes.tolist():
        out.append((blob[at : at + before][::-1], blob[at + before : at + size]))
        at += size
    return p, out


def _covered(dealt: DataFrame) -> DataFrame:
    """(ord, th, whole, begin, begin_key): strings of 200 bytes that occur elsewhere, by their begins; and other stretches, with their ends."""

    def sort(table: pa.Table) -> pa.Table:
        rows = list(rows_of(table))
        found = []
        opened = [_contexts(b, s) for s, k, b in rows if k == CONTEXTS]
        if opened:
            p, contexts = joined([o[0] for o in opened]), [c for o in opened for c in o[1]]
            order = np.argsort(p.keys[0], kind="stable")
            gram = p.keys[0][order]
            cuts = np.concatenate(([0], np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)]))
            begin, end = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1:
                    index = order[a:b].tolist()
                    for i, found_ in zip(index, reach([contexts[i] for i in index])):
                        if found_:
                            begin[i], end[i] = p.at[i] - found_[1], p.at[i] - found_[0] + LENGTH
            index = np.flatnonzero(end)
            index = index[np.lexsort((begin[index], p.doc[index]))]
            index = index[np.argsort(p.stretch[index], kind="stable")]
            q = p.take(index, bare=True)
            q.at, q.keys = begin[index], [end[index].astype(np.uint32)]
            found.append((CONTEXTS, q))
        windows = [unpack(b, s) for s, k, b in rows if k == WINDOWS]
        if windows:
            p = joined(windows)
            order, cls = _group(p.keys[:2])
            again = (np.bincount(cls) > 1) | (np.bincount(cls, p.keys[2][order]) > 0)
            found.append((COVERED, p.take(np.sort(order[again[cls]]), bare=True)))
        return homing(found, [r for r in rows if r[1] not in (CONTEXTS, WINDOWS)])

    homed = dealt.groupBy("part").applyInArrow(sort, HOMING)
    return at_home(homed, {"whole": (COVERED,), "begin": (CONTEXTS,)}, ("begin",))


# --- the operator -------------------------------------------------------------


def dedup_suffixes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", local_hot: int = LOCAL_HOT, hot: int = HOT) -> DataFrame:
    """doc_id, kept, n_bytes, n_removed, spans: what is left of each row's text in UTF-8.

    A byte goes if a string of 200 bytes over it also starts anywhere else, in
    another row or elsewhere in the same, on the input; all copies go, the first
    included.  kept: the remaining bytes (they may break a character); spans:
    the maximal runs [begin, end) that went.  A null text is empty.  A repeated
    row is a copy like any other.

    40 bytes with more than ``local_hot`` different surroundings in one stretch
    of input, or ``hot`` in one part, are not sorted in one task: the strings of
    200 bytes around them are dealt out by their hashes instead, with the same
    result.
    """
    texts = keyed_texts(docs, doc_id, text)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_parts(docs.sparkSession), -(-total // PART_BYTES))
    judged = written(_judge_anchors(_anchor_rows(texts, parts, local_hot), hot), "suffix-anchors")
    covered = _covered(_open_rows(judged, texts, parts))
    nothing = F.lit(None).cast("binary")
    full = judged.where("full IS NOT NULL").select("ord", "th", "full", nothing.alias("whole"), nothing.alias("begin"), nothing.alias("begin_key"))
    gone = by_text(full.unionByName(covered.withColumn("full", nothing)), ["full", "whole", "begin", "begin_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sizes = np.diff(_bytes_of(batch.column(names.index("text")))[1])
            for a, b in slices(sizes, 1 << 22):
                part = batch.slice(a, b - a)
                kept, removed, spans = [], [], []
                for body, found in zip(part.column(names.index("text")).to_pylist(), part.column(names.index("found")).to_pylist()):
                    body, found = body.encode(), found or []
                    at, whole, other, until = (numbers([x[c] for x in found]).astype(np.int64) for c in ("full", "whole", "begin", "begin_key"))
                    begin = np.concatenate((np.maximum(0, at - BACK), whole, other))
                    end = np.concatenate((np.minimum(len(body), at + LENGTH), whole + LENGTH, until))
                    begin, end = spans_of(begin, end)
                    left, last = [], 0
                    for i, j in zip(begin.tolist(), end.tolist()):
                        left.append(body[last:i])
                        last = j
                    left.append(body[last:])
                    kept.append(b"".join(left))
                    removed.append(len(body) - len(kept[-1]))
                    spans.append(np.stack((begin, end), axis=1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(names.index("ord")), pa.array(kept, pa.binary()), pa.array(sizes[a:b], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                    names=["ord", "kept", "n_bytes", "n_removed", "spans"],
                )

    left = texts.join(gone, ["ord", "th"], "left").select("ord", "text", "found").mapInArrow(cut, "ord long, kept binary, n_bytes long, n_removed long, spans array<array<long>>")
    return left.select(F.when(F.col("ord") != F.lit(NULL_LAST), F.col("ord")).alias("doc_id"), "kept", "n_bytes", "n_removed", "spans")


def op4_sql() -> str:
    """DuckDB SQL of op4's rows, over the texts in hexadecimal."""
    return f"""
    WITH t AS (
      SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), w AS (
      SELECT r, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS k FROM t, unnest(range(length(h) // 2 - {LENGTH - 1})) AS u(i) WHERE length(h) >= {2 * LENGTH}
    ), twice AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1
    ), numbered AS (
      SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM (
        SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS new FROM twice)
    ), spans AS (
      SELECT r, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY r, run
    ), between_spans AS (
      SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM spans
    ), cut AS (
      SELECT r, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, count(*) AS n, sum(b - a) AS removed
      FROM between_spans JOIN t USING (r) GROUP BY r
    )
    SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
      sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM t LEFT JOIN cut USING (r)
    """
