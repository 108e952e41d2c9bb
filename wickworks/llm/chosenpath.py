"""Jaccard join over word shingles by chosen paths.

Documents with equal shingle sets are one class; classes have minhash
signatures.  From the root, a class follows a few of the signature's places,
chosen at random but alike for all classes on the same path, and meets in a
bucket those with equal values there.  Small buckets are compared by brute force
on bit sketches.  Of a large bucket a few classes lead: those near a leader are
settled by a tie to it, as whatever they are linked to lies within reach of that
leader and is tied to it too; the rest is split again the same way.  A bucket
that is still large at the deepest level holds classes alike nearly everywhere
and is kept together.  Runs with other random choices are repeated as often as
the target recall asks for.

That yields groups that hold every link found.  Inside a group all pairs are
then compared on their whole sets, in tiles of bounded size, and only counts
and one link per class and tile leave a tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.base import (
    NULL_LAST, as_long, hidden, inside, keyed_texts, mix, shown, shuffle_parts, text_slices, window_hashes, word_hashes, written,
)
from wickworks.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 64
SKETCH_WORDS = 2
BUCKET = 256
DEPTH = 6
RECALL = 0.99
# Chance that sketches rule out a pair at the threshold, in all runs alike.
SKETCH_LOSS = 1e-7
TILE_BYTES = 8 << 20
# Large buckets: leaders (on average), places at which a settled class may differ from its leader, and
# the chance that a pair at the threshold differs at more places than a tie reaches beyond that.
LEADERS = 16
SETTLED = 12
REACH_LOSS = 1e-4
# Leaders of a level's large buckets, and the members of the first level's, are broadcast up to this size.
LEADER_BYTES = 32 << 20


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(start of each text in the hashes, hashes of its distinct shingles in order).

    A text of fewer words than a shingle has one, of all its words; one without words none.
    """
    starts, h = word_hashes(texts)
    ok = inside(starts, size)
    n_words = np.diff(starts)
    counts = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(begin[-1], np.uint64)
    long_rows = np.repeat(n_words >= size, counts)
    out[long_rows] = window_hashes(h, size)[ok]
    for i in np.flatnonzero((n_words > 0) & (n_words < size)):
        out[begin[i]] = window_hashes(h[starts[i] : starts[i + 1]], int(n_words[i]), 0xA5A5 + int(n_words[i]))[0]
    for a, b in zip(begin[:-1], begin[1:]):
        if b - a > 1:
            out[a:b].sort()
    first = np.ones(len(out), bool)
    first[1:] = out[1:] != out[:-1]
    first[begin[:-1][counts > 0]] = True
    return np.concatenate(([0], np.cumsum(first)))[begin], out[first]


def signatures(starts: np.ndarray, h: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Minhash values, a row of ``places`` 32-bit numbers for each set with a member."""
    full = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(full), places), np.uint32)
    for j in range(places):
        a = mix(np.array([2 * j + 1], np.uint64))[0] | np.uint64(1)
        out[:, j] = np.minimum.reduceat(((h ^ (h >> np.uint64(29))) * a) >> np.uint64(32), full)
    return out


def _sets(texts: DataFrame, size: int, places: int) -> DataFrame:
    """(ord, th, n, k1, k2, sig): the set's size, its identity and its signature; n = 0 without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                starts, h = shingles(part.column(2), size)
                n = np.diff(starts)
                keys = []
                for salt in (3, 5):
                    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(mix(h + np.uint64(salt)))))
                    keys.append(pa.array(as_long(sums[starts[1:]] - sums[starts[:-1]])))
                sig = np.zeros((len(n), places), np.uint32)
                if len(h):
                    sig[n > 0] = signatures(starts, h, places)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), *keys, pa.array([s.tobytes() for s in sig], pa.binary())], names=["ord", "th", "n", "k1", "k2", "sig"])

    return texts.mapInArrow(sign, "ord long, th long, n long, k1 long, k2 long, sig binary")


def recall_of(runs: int, similarity: float, threshold: float, depth: int, places: int = PLACES) -> float:
    """Chance that a pair of that Jaccard similarity meets at ``depth`` in one of ``runs`` runs.

    All runs read the same signatures, so the mean is taken over the number of
    places at which the pair agrees: each of them is followed with the chance
    1 / (threshold * places) on each path.
    """
    agree = np.arange(places + 1)
    share = np.array([math.comb(places, k) * similarity**k * (1 - similarity) ** (places - k) for k in agree])
    p = np.ones(places + 1)
    for _ in range(depth):
        p = 1 - (1 - p / (threshold * places)) ** agree
    return float((share * (1 - (1 - p) ** runs)).sum())


def runs_for(recall: float, threshold: float, depth: int, places: int = PLACES) -> int:
    """Runs after which a pair at the threshold has met at ``depth`` with chance ``recall``."""
    best = recall_of(1 << 20, threshold, threshold, depth, places)
    if recall >= best:
        raise ValueError(f"signatures of {places} places reach a recall of {best:.6f} at most")
    high = 1
    while recall_of(high, threshold, threshold, depth, places) < recall:
        high *= 2
    return next(r for r in range(max(1, high // 2), high + 1) if recall_of(r, threshold, threshold, depth, places) >= recall)


def least_agreement(threshold: float, loss: float = SKETCH_LOSS, places: int = PLACES) -> int:
    """The number of sketch bits at which two sets at the threshold agree but for a chance of ``loss``.

    The bits of a place go together: all agree where its values do, else each by chance.
    """
    one = [(1 - threshold) * math.comb(SKETCH_WORDS, k) / 2**SKETCH_WORDS + (k == SKETCH_WORDS) * threshold for k in range(SKETCH_WORDS + 1)]
    chance = np.ones(1)
    for _ in range(places):
        chance = np.convolve(chance, one)
    return int(np.searchsorted(np.cumsum(chance), loss, side="right"))


def most_apart(threshold: float, loss: float = REACH_LOSS, places: int = PLACES) -> int:
    """The number of places that two signatures at the threshold differ at, more only with a chance of ``loss``."""
    share = [math.comb(places, k) * (1 - threshold) ** k * threshold ** (places - k) for k in range(places + 1)]
    return int(np.searchsorted(np.cumsum(share), 1 - loss))


def _children(paths: np.ndarray, sig: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of the row, path of the child) for the places that each path chooses."""
    places = np.arange(sig.shape[1], dtype=np.uint64)
    u = mix(paths[:, None] + (places + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    row, place = np.nonzero(u < np.uint64(int(chance * 2**64)))
    child = mix(u[row, place] ^ (sig[row, place].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return row, child


def _sketches(sig: np.ndarray) -> np.ndarray:
    """128 bits of each signature, as two numbers: a bit of its place's value each."""
    bits = mix(sig.astype(np.uint64)[:, :, None] * np.uint64(64) + np.arange(SKETCH_WORDS, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).transpose(0, 2, 1), axis=2).view(np.int64)[:, :, 0]


def _split(rows: DataFrame, threshold: float, places: int, runs: int | None = None) -> DataFrame:
    """Each class in the next buckets: (path, cid) of all runs from the root for rows (cid, sig),
    or (path, cid, sig) for rows (cid, sig, path)."""
    names = ["path", "cid", "sig"][: 2 if runs else 3]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 4096):
                batch = whole.slice(k, 4096)
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, places)
                cid = batch.column(0).to_numpy()
                starts = [np.full(len(cid), mix(np.array([r + 1], np.uint64))[0]) for r in range(runs)] if runs else [batch.column(2).to_numpy().view(np.uint64)]
                for paths in starts:
                    row, child = _children(paths, sig, 1 / (threshold * places))
                    columns = [pa.array(as_long(child)), pa.array(cid[row])]
                    yield pa.RecordBatch.from_arrays(columns if runs else [*columns, batch.column(1).take(pa.array(row))], names=names)

    return rows.mapInArrow(deal, "path long, cid long" + ("" if runs else ", sig binary"))


def _sketched(classes: DataFrame, places: int) -> DataFrame:
    """(cid, s1, s2) of classes (cid, sig)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _sketches(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, places))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits[:, 0]), pa.array(bits[:, 1])], names=["cid", "s1", "s2"])

    return classes.select("cid", "sig").mapInArrow(sketch, "cid long, s1 long, s2 long")


def _leaders(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's component, from a symmetric matrix of links."""
    n = len(linked)
    lead = np.arange(n)
    while True:
        least = np.where(linked, lead[None, :], n).min(axis=1, initial=n)
        new = np.minimum(lead, least)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new


def _bucket_edges(buckets: DataFrame, agree: int) -> DataFrame:
    """Edges (a, b) from small buckets (members: cid, s1, s2): classes whose sketches agree, each tied to the first of its component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            cid, s1, s2 = (flat.field(i).to_numpy() for i in range(3))
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            a, b = [], []
            for i, j in zip(at[:-1], at[1:]):
                if j - i == 2:
                    differ = sum((int(s[i] ^ s[i + 1]) & (2**64 - 1)).bit_count() for s in (s1, s2))
                    if 128 - differ >= agree:
                        a.append(cid[i : i + 1])
                        b.append(cid[i + 1 : i + 2])
                    continue
                differ = np.bitwise_count((s1[i:j, None] ^ s1[None, i:j]).view(np.uint64)).astype(np.int16) + np.bitwise_count((s2[i:j, None] ^ s2[None, i:j]).view(np.uint64))
                lead = _leaders(128 - differ >= agree)
                own = np.flatnonzero(lead != np.arange(j - i))
                a.append(cid[i:j][lead[own]])
                b.append(cid[i:j][own])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*a, np.zeros(0, np.int64)])), pa.array(np.concatenate([*b, np.zeros(0, np.int64)]))], names=["a", "b"])

    return buckets.mapInArrow(compare, "a long, b long")


def _settled(large: DataFrame, sizes: DataFrame, threshold: float, places: int, leaders: int) -> DataFrame:
    """(path, cid, sig, settled, ties) of the classes of large buckets: the leaders that each is tied to, and is it near one.

    The places at which signatures differ are a distance: a class linked to a
    settled one is at most ``SETTLED`` and ``most_apart`` places away from its
    leader, which is as far as ties reach.  A class is tied to the first leader
    of each set of leaders that are themselves within reach of one another.
    """
    reach = places - min(places, SETTLED + most_apart(threshold, places=places))
    unit = 1 << 30
    chosen = F.pmod(F.xxhash64("cid", "path"), F.lit(unit)) < F.lit(leaders * unit) / F.col("size")
    lead = large.select("path", "cid", "sig").join(sizes, "path").where(chosen)
    lead = written(lead.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("cid", "sig"))).alias("leaders")), "path-leaders")  # a few a bucket, however large it is

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, places)
            path, lists = batch.column(0).to_numpy(), batch.column(3)
            settled, ties = np.zeros(len(sig), bool), [[] for _ in range(len(sig))]
            _, first, at = np.unique(path, return_index=True, return_inverse=True)
            for k, i in enumerate(first):
                found = lists[int(i)].as_py()
                if not found:
                    continue
                rows = np.flatnonzero(at == k)
                cid, of = np.array([x["cid"] for x in found]), np.frombuffer(b"".join(x["sig"] for x in found), np.uint32).reshape(-1, places)
                heads = _leaders((of[:, None] == of[None]).sum(axis=2) >= reach)
                alike = (sig[rows][:, None] == of[None]).sum(axis=2)
                settled[rows] = alike.max(axis=1) >= places - SETTLED
                for r, near in zip(rows, alike >= reach):
                    ties[r] = cid[np.unique(heads[near])].tolist()
            rest = pc.if_else(pa.array(settled), pa.scalar(None, pa.binary()), batch.column(2))  # a settled class needs its signature no more
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], rest, pa.array(settled), pa.array(ties, pa.list_(pa.int64()))], names=["path", "cid", "sig", "settled", "ties"])

    # the leaders of some thousand buckets are small, whatever the buckets' sizes; those of more are joined by a shuffle
    most = F.broadcast(lead) if sizes.count() * leaders * (places * 4 + 8) <= LEADER_BYTES else lead.hint("merge")
    both = large.select("path", "cid", "sig").join(most, "path", "left")
    return written(both.mapInArrow(tie, "path long, cid long, sig binary, settled boolean, ties array<long>"), "path-ties")


def loose_groups(classes: DataFrame, threshold: float, recall: float, places: int = PLACES, bucket: int = BUCKET, depth: int = DEPTH, leaders: int = LEADERS) -> DataFrame:
    """(id, comp): groups of classes (cid, sig) that hold all links found by chosen paths."""
    agree = least_agreement(threshold, places=places)
    rows = _split(classes.select("cid", "sig"), threshold, places, runs_for(recall, threshold, depth, places))
    small = ties = None
    for level in range(1, depth + 1):
        # the few classes of large buckets carry their signatures from level to level
        rows = written(rows, "paths")
        sizes = written(rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), "path-sizes")
        few = rows.join(sizes.where(F.col("size") <= bucket).select("path"), "path").select("path", "cid")
        small = few if small is None else small.unionByName(few)
        large = rows.join(sizes.where(F.col("size") > bucket).select("path"), "path")
        if level == depth or sizes.where(F.col("size") > bucket).isEmpty():
            break
        big = sizes.where(F.col("size") > bucket)
        if level == 1:
            fits = big.agg(F.sum("size")).first()[0] * 16 <= LEADER_BYTES
            large = (F.broadcast(large) if fits else large.hint("merge")).join(classes.select("cid", "sig"), "cid")
        seen = _settled(written(large.select("path", "cid", "sig"), "path-large"), big, threshold, places, leaders)
        tied = seen.select(F.explode("ties").alias("a"), F.col("cid").alias("b"))
        ties = tied if ties is None else ties.unionByName(tied)
        rows = _split(seen.where("NOT settled").select("cid", "sig", "path"), threshold, places)
    small = small.join(_sketched(classes, places).hint("merge"), "cid")
    edges = _bucket_edges(small.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("cid", "s1", "s2"))).alias("members")).select("members"), agree)
    first = large.groupBy("path").agg(F.min("cid").alias("a"))
    edges = edges.unionByName(large.join(first, "path").select("a", F.col("cid").alias("b")))
    return components(edges if ties is None else edges.unionByName(ties))


def _compare(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets of ``a`` and ``b`` (of ``a`` alone if None, each pair both ways) have Jaccard ``threshold`` or more."""
    alone = b is None
    b = a if alone else b
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    common = np.zeros((len(a), len(b)), np.float32)
    if len(a) * len(b) <= 16:
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                if not alone or i < j:
                    common[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        if alone:
            common = common + common.T
    else:
        _, at, uses = np.unique(np.concatenate(a + ([] if alone else b)), return_inverse=True, return_counts=True)
        number = np.where(uses > 1, np.cumsum(uses > 1) - 1, -1)  # what only one set has is common to none
        words, at = int((uses > 1).sum()), number[at]
        ra, rb = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
        pa_, pb_ = (at, at) if alone else (at[: len(ra)], at[len(ra) :])
        step = max(256, (8 << 20) // (len(a) + len(b)))
        for lo in range(0, words, step):
            ma, mb = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
            for m, r, p in ((ma, ra, pa_), (mb, rb, pb_)):
                here = (p >= lo) & (p < lo + step)
                m[r[here], p[here] - lo] = 1
            common += ma @ mb.T
    common = common.astype(np.float64)
    linked = common >= threshold * (na[:, None] + nb[None, :] - common) - 1e-9
    if alone:
        np.fill_diagonal(linked, False)
    return linked


def _links(tiles: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, a): per class and tile the documents linked to it, and one class that all it is tied to there name."""

    def count(table: pa.Table) -> pa.Table:
        cid, tile, side, m = (table.column(c).to_numpy() for c in ("cid", "tile", "side", "m"))
        order = np.lexsort((cid, side, tile))
        keep = np.concatenate(([True], (np.diff(tile[order]) != 0) | (np.diff(side[order]) != 0) | (np.diff(cid[order]) != 0)))
        order = order[keep]  # a repeated row brings its set twice
        sets = table.column("set").take(pa.array(order)).to_pylist()
        cid, tile, side, m = cid[order], tile[order], side[order], m[order]
        out: list[list[np.ndarray]] = [[], [], []]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]))
        for i, j in zip(cuts[:-1], cuts[1:]):
            x = [np.frombuffer(s, np.uint64) for s in sets[i:j]]
            cut = int(np.searchsorted(side[i:j], 1))  # two sides only where two blocks meet
            if cut == j - i:
                linked = _compare(x, None, threshold)
            else:
                half = _compare(x[:cut], x[cut:], threshold)
                linked = np.zeros((j - i, j - i), bool)
                linked[:cut, cut:], linked[cut:, :cut] = half, half.T
            lead = _leaders(linked)
            out[0].append(cid[i:j])
            out[1].append((linked * m[None, i:j]).sum(axis=1))
            out[2].append(cid[i:j][lead])
        return pa.table({"cid": np.concatenate(out[0]), "links": np.concatenate(out[1]).astype(np.int64), "a": np.concatenate(out[2])})

    return tiles.groupBy("deal").applyInArrow(count, "cid long, links long, a long")


def join_classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, doc_id: str = "doc_id", text: str = "text", tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(ord, th, low_ord, low_th, links): each row's key, the least key of its class, and how many other rows it is linked to.

    Rows are linked if the Jaccard similarity of their sets of ``size`` words in
    a row is ``threshold`` or more; a class is a connected set of links.
    """
    texts = keyed_texts(docs, doc_id, text)
    spark = docs.sparkSession
    sets = written(_sets(texts, size, PLACES), "shingle-sets")
    by_set = sets.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(F.struct("ord", "th")).alias("rep"), F.count("*").alias("m"), F.min("sig").alias("sig"))
    classes = written(by_set.select("*", "rep.*").drop("rep").withColumn("cid", F.monotonically_increasing_id()), "shingle-classes")

    groups = loose_groups(classes, threshold, recall).withColumnRenamed("id", "cid")
    members = written(classes.join(groups, "cid").select("cid", "comp", "ord", "th", "n", "m"), "shingle-members")
    weight = members.groupBy("comp").agg(F.greatest(F.ceil(F.sum("n") * 8 / tile_bytes), F.ceil(F.count("*") / 1024)).cast("int").alias("blocks"))
    total = members.agg(F.sum("n")).first()[0] or 0
    deals = max(shuffle_parts(spark), -(-total * 8 // tile_bytes))
    members = members.join(weight, "comp").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                starts, h = shingles(part.column(part.schema.get_field_index("text")), size)
                whole = [h[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(whole, pa.binary())], names=["cid", "comp", "m", "block", "blocks", "set"])

    # texts move once whatever the sizes: no broadcast here that a larger input would not have
    whole = members.select("ord", "th", "cid", "comp", "m", "block", "blocks").join(texts.hint("merge"), ["ord", "th"]).select("cid", "comp", "m", "block", "blocks", "text")
    whole = whole.mapInArrow(cut, "cid long, comp long, m long, block int, blocks int, set binary")
    # a block meets itself and every other block of its group
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tile = F.when(F.col("blocks") == 1, F.col("comp")).otherwise(F.xxhash64("comp", low, high))
    dealt = whole.withColumn("other", other).withColumn("tile", tile).withColumn("side", (F.col("block") > F.col("other")).cast("int")).withColumn("deal", F.pmod(F.xxhash64("tile", "blocks"), F.lit(deals)))
    links = written(_links(dealt.select("deal", "tile", "side", "cid", "m", "set"), threshold), "shingle-links")

    tied = components(links.select("a", F.col("cid").alias("b"))).withColumnRenamed("id", "cid")
    counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
    found = classes.select("k1", "k2", "n", "ord", "th", "m", "cid").join(counts, "cid", "left").join(tied, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    found = written(found, "shingle-found")
    least = found.groupBy("comp").agg(F.min(F.struct("ord", "th")).alias("low"))
    by_class = found.join(least, "comp").select("k1", "k2", "n", F.col("low.ord").alias("low_ord"), F.col("low.th").alias("low_th"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"))
    rows = sets.select("ord", "th", "n", "k1", "k2").join(by_class, ["k1", "k2", "n"], "left")
    return rows.select("ord", "th", F.coalesce("low_ord", "ord").alias("low_ord"), F.coalesce("low_th", "th").alias("low_th"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links of each row (see ``join_classes``).

    class_id is the smallest doc_id of the class (null if all are null); n_links
    counts the other rows linked to the row, copies included.  A text without
    words is linked to nothing and a class by itself; one of fewer words than a
    shingle has a single shingle, of all its words.
    """
    rows = join_classes(docs, **options)
    named = [F.when(F.col(c) != F.lit(NULL_LAST), F.col(c)).alias(n) for c, n in (("ord", "doc_id"), ("low_ord", "class_id"))]
    return rows.select(*named, F.col("links").alias("n_links"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates of a kept one: of each class the least (doc_id, text hash), once. All columns kept."""
    low = join_classes(docs, **options).select(F.col("low_ord").alias("ord"), F.col("low_th").alias("th")).distinct()
    id_, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    keyed = hidden(docs).withColumns({"ord": F.coalesce(id_.cast("long"), F.lit(NULL_LAST)), "th": F.xxhash64(F.coalesce(text, F.lit("")))})
    first = keyed.withColumn("i", F.row_number().over(Window.partitionBy("ord", "th").orderBy(text))).where("i = 1")
    return shown(first.join(low, ["ord", "th"], "left_semi"), docs.columns)


def op8_sql(size: int = SHINGLE) -> str:
    """DuckDB SQL of op8's rows, by comparing all texts that share a shingle."""
    return f"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), s AS (
      SELECT DISTINCT doc_id, array_to_string(words[i:i + {size - 1}], ' ') AS g FROM w, unnest(range(1, greatest(len(words) - {size - 2}, 2))) AS u(i) WHERE len(words) > 0
    ), n AS (
      SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), p AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
    ), l AS (
      SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)
    ), e AS (
      SELECT a, b FROM l UNION ALL SELECT b, a FROM l
    ), reached AS (
      SELECT a AS doc_id, a AS x FROM e UNION SELECT doc_id, b FROM reached JOIN e ON a = x
    ), classes AS (
      SELECT doc_id, min(x) AS class_id FROM reached GROUP BY doc_id
    ), links AS (
      SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a
    )
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links
    FROM documents LEFT JOIN classes USING (doc_id) LEFT JOIN links USING (doc_id)
    """
