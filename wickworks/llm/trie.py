"""Prefix trie of conversations, by time-forward processing.

A node is a distinct sequence of turns with which some conversation begins; its
key is the sum of hashes of its turns, each hashed with its place, so that keys
are running sums along a conversation and no text is moved.

Totals of subtrees are passed upwards.  Nodes are cut into shards by their
members: level 0 holds nodes of fewer than ``WIDTH`` conversations, level 1 those
of fewer than its square, and so on, and a shard is what hangs together on one
level, so that it has fewer than ``WIDTH`` nodes at any depth however common a
turn is.  Within a shard nodes come in reverse level order (Spark's external
sort), and a node sends its total to its parent through a priority queue that
spills; the totals of shard roots are summed by parent and enter the shards of
the next level.  There are as many rounds as levels, three for a thousand
million conversations.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.base import shuffle_parts, written

WIDTH = 1024
FAMILY, HEADS = 100, 6
QUEUE = 100_000
RUNS = 64
CHUNK = 4096
KEY = ["depth", "k1", "k2"]
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` of them in memory.

    What is over is written as a sorted run to an unnamed file of the task, which
    is gone with the task; runs are read again a chunk at a time, and merged when
    there are many.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.n_runs = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._start(self._stored(sorted(self.heap)))
            self.heap = []
            if len(self.runs) > RUNS:
                merged = self._stored(heapq.merge(*[self._rest(r) for r in self.runs]))
                self.runs = []
                self._start(merged)

    def pop_equal(self, key: tuple) -> Iterator[tuple]:
        """Takes out the least items while they begin with ``key``."""
        n = len(key)
        while (from_heap := bool(self.heap) and (not self.runs or self.heap[0] <= self.runs[0][0])) or self.runs:
            item = self.heap[0] if from_heap else self.runs[0][0]
            if item[:n] != key:
                return
            if from_heap:
                heapq.heappop(self.heap)
            else:
                _, no, rest = heapq.heappop(self.runs)
                self._start(rest, no)
            yield item

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def _start(self, rest: Iterator[tuple], no: int | None = None) -> None:
        if no is None:
            self.n_runs += 1
            no = self.n_runs
        if (first := next(rest, None)) is not None:
            heapq.heappush(self.runs, (first, no, rest))

    @staticmethod
    def _rest(run: tuple) -> Iterator[tuple]:
        yield run[0]
        yield from run[2]

    @staticmethod
    def _stored(items) -> Iterator[tuple]:
        file, chunk = tempfile.TemporaryFile(), []
        for item in items:
            chunk.append(item)
            if len(chunk) == 1000:
                pickle.dump(chunk, file)
                chunk = []
        pickle.dump(chunk, file)
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        return read()


def ordered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, seq, t1, t2, chars): the turns of each conversation from 1 on, their hashes and lengths in code points.

    A null turn number comes first; turns of equal numbers come in the order of
    their hashes.  Null role or text counts as empty.  Rows without a conv_id
    belong to no conversation and are left out.
    """
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("t1"), F.xxhash64(F.lit(7), t, r).alias("t2"), F.length(t).cast("long").alias("chars")
    )
    return rows.select("conv", F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "t1", "t2")).alias("seq"), "t1", "t2", "chars")


def whole(turns: DataFrame) -> DataFrame:
    """``ordered`` turns as rows for ``prefix_trie``: (conv, at, t1, t2, chars), the start of each conversation at 0."""
    start = turns.where("seq = 1").select("conv", F.lit(0).alias("at"), *[F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "chars")])
    return start.unionByName(turns.withColumnRenamed("seq", "at"))


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``ordered`` turns as rows for ``prefix_trie``, each conversation with another beginning.

    Its first h = crc32(id) % ``heads`` turns are those of the first conversation
    of its family of ``family`` ids (all, if that has fewer; none, if there is no
    such conversation); its own turns follow after its own first h.  A
    conversation may be left without a turn.
    """
    own = turns.withColumns({"h": (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int"), "first": F.col("conv") - F.col("conv") % family})
    turn = F.struct("seq", "t1", "t2", "chars")
    shared = own.where((F.col("conv") == F.col("first")) & (F.col("seq") < heads)).groupBy("first").agg(F.sort_array(F.collect_list(turn)).alias("head"))  # fewer than ``heads`` turns
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(0).alias("seq"), zero.alias("t1"), zero.alias("t2"), zero.alias("chars"))
    begun = own.where("seq = 1").join(shared, "first", "left")
    begun = begun.select("conv", F.explode(F.concat(F.array(start), F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array()))).alias("x"))
    begun = begun.select("conv", (F.col("x.seq") - heads).alias("at"), "x.t1", "x.t2", "x.chars")
    return begun.unionByName(own.where("seq > h").select("conv", F.col("seq").alias("at"), "t1", "t2", "chars"))


def _level(n: Column, width: int) -> Column:
    out, k = F.lit(0), 1
    while width**k < 2**62:
        out = F.when(n >= width**k, k).otherwise(out)
        k += 1
    return out


def prefixes(rows: DataFrame) -> DataFrame:
    """A row per conversation and prefix: conv, depth, its key k1, k2, chars of its last turn, last (is it the whole conversation).

    A key has 128 bits, in four sums of 32 bits.  A conversation is sorted and
    summed up as a stream in one task, whose sort spills.
    """
    w = Window.partitionBy("conv").orderBy("at")
    low = F.lit(0xFFFFFFFF).cast("long")
    sums = {}
    for k, place in (("k1", F.xxhash64("depth", "t1", "t2")), ("k2", F.xxhash64(F.lit(11), "t2", "depth", "t1"))):
        h = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(place)
        parts = [F.sum(x).over(w).bitwiseAND(low) for x in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
        sums[k] = parts[0].bitwiseOR(F.shiftleft(parts[1], 32))
    rows = rows.withColumn("depth", (F.row_number().over(w) - 1).cast("long")).withColumns(sums)
    return rows.select("conv", *KEY, "chars", F.lead("at").over(w).isNull().alias("last"))


def _sharded(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with their parents (p_...) and shards: each is found along its smallest member's prefixes."""
    along = rows.select("conv", *KEY).join(nodes, KEY)
    w = Window.partitionBy("conv").orderBy("depth")
    up = lambda c: F.lag(c).over(w)
    along = along.withColumns({f"p_{c}": up(c) for c in ("k1", "k2", "level", "conv_id")})
    top = F.when(F.col("p_level").isNull() | (F.col("p_level") != F.col("level")), F.col("k1"))
    along = along.withColumn("shard", F.last(top, ignorenulls=True).over(w)).withColumn("p_shard", up("shard"))
    return along.where("conv = conv_id").drop("conv")


def _upwards(rows: DataFrame, queue: int) -> DataFrame:
    """Totals of the nodes of one level, from ``rows`` of nodes and (node false) of what came from other shards."""
    sums = ["n_children", "n_leaves", "saved_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            at, out = [], {c: [] for c in sums}
            for i, (depth, k1, k2) in enumerate(zip(col["depth"], col["k1"], col["k2"])):
                if not col["node"][i]:
                    waiting.push((-depth, k1, k2, *(col[c][i] for c in sums)))
                    continue
                children, leaves, saved = 0, 0, (col["n_convs"][i] - 1) * col["chars"][i]
                for m in waiting.pop_equal((-depth, k1, k2)):
                    children, leaves, saved = children + m[3], leaves + m[4], saved + m[5]
                leaves = leaves or 1
                if col["p_level"][i] == col["level"][i]:
                    waiting.push((1 - depth, col["p_k1"][i], col["p_k2"][i], 1, leaves, saved))
                at.append(i)
                for c, v in zip(sums, (children, leaves, saved)):
                    out[c].append(v)
            part = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], pa.int64()) if n in out else part.column(i) for i, n in enumerate(part.schema.names)], schema=batch.schema)
        if waiting:
            raise ValueError("a total has no parent")

    dealt = rows.repartition(shuffle_parts(rows.sparkSession), "shard").sortWithinPartitions(F.desc("depth"), "k1", "k2", "node")
    return dealt.mapInArrow(run, dealt.schema)


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes at which conversations end.

    The ids are sorted by ranges, so that those of one node may lie in many
    tasks, and joined there to texts of ``CHUNK`` ids; the hash runs over the
    texts of a node in order.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, done = None, [], []
        for batch in batches:
            for *key, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if ids and (key != node or len(ids) == CHUNK):
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = key
                ids.append(conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "first", "ids"])
                done = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, ids[0], ",".join(map(str, ids)))], names=[*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key == node:
                    sha.update(b",")
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])
                done = []
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=[*KEY, "ends_sha256"])

    n, key = shuffle_parts(rows.sparkSession), "depth long, k1 long, k2 long, "
    ends = rows.where("last").select(*KEY, "conv").repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    texts = ends.mapInArrow(pack, key + "first long, ids string").repartition(n, *KEY).sortWithinPartitions(*KEY, "first")
    return texts.mapInArrow(digest, key + "ends_sha256 string")


def prefix_trie(rows: DataFrame, width: int = WIDTH, queue: int = QUEUE) -> DataFrame:
    """The trie of the conversations in ``rows`` (of ``whole`` or ``rebuilt``): a row per node.

    conv_id: its smallest member; depth; parent_conv_id: its parent's conv_id
    (null for the root, depth 0); n_convs: members; n_children; n_leaves:
    childless nodes of its subtree, itself included; saved_tokens: (members - 1)
    times the code points of the last text, summed over its subtree;
    ends_sha256: of the comma-joined ids of the conversations that end here.
    Without conversations there is no row.
    """
    rows = written(prefixes(rows), "trie-prefixes")
    nodes = rows.groupBy(*KEY).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.min("chars").alias("chars"))
    nodes = written(nodes.withColumn("level", _level(F.col("n_convs"), width)), "trie-members")  # read anew, so that a join can split a common prefix
    nodes = written(_sharded(rows, nodes), "trie-nodes")
    top = nodes.agg(F.max("level")).first()[0]
    zero = F.lit(0).cast("long")
    nodes = nodes.withColumns({"node": F.lit(True), "n_children": zero, "n_leaves": zero, "saved_tokens": zero})
    done: list[DataFrame] = []
    for level in range((-1 if top is None else top) + 1):
        here = nodes.where(F.col("level") == level)
        for lower in done:
            sent = lower.where((F.col("p_level") == level) & (F.col("level") < level))
            sums = [F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
            sent = sent.groupBy((F.col("depth") - 1).alias("depth"), F.col("p_k1").alias("k1"), F.col("p_k2").alias("k2"), F.col("p_shard").alias("shard")).agg(*sums)
            here = here.unionByName(sent.withColumn("node", F.lit(False)), allowMissingColumns=True)
        done.append(written(_upwards(here, queue), "trie-totals"))
    total = done[0] if done else nodes
    for more in done[1:]:
        total = total.unionByName(more)
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    return total.join(_ends(rows), KEY, "left").select("conv_id", "depth", F.col("p_conv_id").alias("parent_conv_id"), *RESULT[3:-1], ends)


def op12_sql(family: int = FAMILY, heads: int = HEADS) -> str:
    """DuckDB SQL of op12's rows; CRC-32 is computed bit by bit."""
    bits = ", ".join(["-1"] * 8)
    return f"""
    WITH t AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL
    ), c AS (
      SELECT conv_id, conv_id - conv_id % {family} AS base,
        xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(strlen(s)), lambda i: [CAST(ascii(s[i + 1]) AS BIGINT), {bits}]))),
          lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % {heads} AS h
      FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)
    ), r AS (
      SELECT c.conv_id, 0 AS part, 0 AS seq, '' AS turn, 0 AS chars FROM c
      UNION ALL SELECT c.conv_id, 1, t.seq, strlen(role) || ':' || role || strlen(text) || ':' || text, length(text) FROM c JOIN t ON t.conv_id = c.base AND t.seq <= c.h
      UNION ALL SELECT c.conv_id, 2, t.seq, strlen(role) || ':' || role || strlen(text) || ':' || text, length(text) FROM c JOIN t ON t.conv_id = c.conv_id AND t.seq > c.h
    ), p AS (
      SELECT conv_id, row_number() OVER w - 1 AS depth, chars, md5(string_agg(turn, ';') OVER w) AS node, lead(seq) OVER w IS NULL AS is_last
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, seq)
    ), x AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM p),
    n AS (
      SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_last), '')) AS ends_sha256
      FROM x GROUP BY depth, node
    ), k AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, node)),
    s AS (
      SELECT x.depth, x.node, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, CAST(sum((m.n_convs - 1) * m.chars) AS BIGINT) AS saved_tokens
      FROM m JOIN x ON x.conv_id = m.conv_id AND x.depth <= m.depth GROUP BY x.depth, x.node
    )
    SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
    FROM m JOIN s USING (depth, node) LEFT JOIN m AS up ON up.depth = m.depth - 1 AND up.node = m.parent
    """
