import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wickworks.llm import trie


def family(convs):
    """Rebuilt conversations, from {id: [(role, text)]}."""
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(first, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = {}
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in members)]
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        rows[node] = (
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(len(n) == len(node) + 1 for n in below), len(childless),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return rows.values()


def table(spark, convs, more=()):
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([*rows, *more], "conv_id long, turn long, role string, text string").repartition(3)


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0], r[3:]))


def some(seed, n=60, ids=350):
    rng = random.Random(seed)
    out = {}
    for c in rng.sample(range(-30, ids), n):
        out[c] = [(rng.choice("ua"), rng.choice(["hi", "é", "", "longer text"])) for _ in range(rng.choice((1, 2, 3, 8)))]
    return out | {c: [("u", "same"), ("a", "copy")] for c in range(400, 430)}


@pytest.mark.parametrize("width", [2, 5, 1024])
def test_same_as_brute_force(spark, width):
    convs = some(width)
    turns = trie.ordered(table(spark, convs))
    assert key(trie.prefix_trie(trie.whole(turns), width, queue=3).collect()) == key(brute(convs))
    assert key(trie.prefix_trie(trie.rebuilt(turns), width).collect()) == key(brute(family(convs)))


def test_nulls_ties_and_turnless_conversations(spark):
    convs = {c: [("", "")] for c in (7, 101, 202, 303, 404)}  # some are left without a turn
    rows = [(c, None, None, None) for c in convs] + [(None, 1, "u", "lost"), (None, None, None, None)]
    got = trie.prefix_trie(trie.rebuilt(trie.ordered(table(spark, {}, rows)))).collect()
    want = brute(family(convs))
    assert key(got) == key(want) and any(r["depth"] == 0 and r["ends_sha256"] != hashlib.sha256().hexdigest() for r in got)
    convs = {1: [("u", "null first"), ("u", "zero"), ("u", "one"), ("u", "one")]}
    rows = [(1, 1, "u", "one"), (1, 0, "u", "zero"), (1, None, "u", "null first"), (1, 1, "u", "one")]
    named = table(spark, {}, rows).withColumnsRenamed({"conv_id": "conv", "text": "depth"}).selectExpr("*", "1 AS k1", "2 AS seq")
    assert key(trie.prefix_trie(trie.whole(trie.ordered(named, "conv", "turn", "role", "depth"))).collect()) == key(brute(convs))
    assert trie.prefix_trie(trie.rebuilt(trie.ordered(table(spark, {})))).count() == 0


def test_long_conversation(spark):
    convs = {1: [("u", str(i % 7)) for i in range(3000)], 2: [("u", str(i % 7)) for i in range(2990)] + [("a", "x")]}
    got = trie.prefix_trie(trie.whole(trie.ordered(table(spark, convs))), width=2).collect()
    assert len(got) == 3002 and {r["n_leaves"] for r in got if r["depth"] <= 2990} == {2}
    assert max(got, key=lambda r: r["saved_tokens"])["saved_tokens"] == 2990


def test_spilling_queue_gives_back_in_order():
    rng = random.Random(2)
    items = [(rng.randrange(50), i, rng.random()) for i in range(5000)]
    q = trie.SpillingQueue(limit=7)
    for x in items:
        q.push(x)
    got = [x for k in range(50) for x in q.pop_equal((k,))]
    assert got == sorted(items) and not q and list(q.pop_equal((1,))) == []
