import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_rows, frame, jaccard_classes, random_texts
from wickworks.llm import chosenpath, decontam
from wickworks.llm.graph import components


def near_texts(seed, n=50):
    """Random texts, and copies of them with a few words changed."""
    rng = random.Random(seed)
    out = random_texts(seed, n, 3000, 200)
    for i in range(0, n, 3):
        for changes in (1, 2, 4):
            w = out[i].split()
            for _ in range(min(changes, len(w) // 40)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_matches_brute_force(spark, seed):
    texts = near_texts(seed)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.jaccard_join(frame(spark, texts)).collect()}
    want = dict(enumerate(jaccard_classes(texts)))
    assert sum(n for _, n in want.values()) > 40
    assert got == want


def test_many_near_copies_in_small_buckets_and_tiles(spark):
    """A group over the bucket size is split, kept together at the deepest level, and compared in tiles."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join([*base[: i % 97], f"own{i}", *base[i % 97 :]]) for i in range(400)] + random_texts(9, 30, 2000)
    got = chosenpath.jaccard_join(frame(spark, texts), tile_bytes=1 << 17).collect()
    want = jaccard_classes(texts)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == dict(enumerate(want))


def test_large_buckets_lose_no_link(spark):
    rng = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for _ in range(160):  # copies of one text with few and many changes, and strangers that share its beginning
        body = list(base)
        for _ in range(rng.choice((1, 2, 4, 6))):
            body[rng.randrange(len(body))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(body))
    texts += [" ".join(base[:60] + [f"s{i}_{j}" for j in range(100)]) for i in range(60)]
    want = jaccard_classes(texts)
    sets = chosenpath._sets(chosenpath.keyed_texts(frame(spark, texts)), 5, 64)
    classes = sets.select(F.col("ord").alias("cid"), "sig")
    for leaders in (16, 2):
        group = {r["id"]: r["comp"] for r in chosenpath.loose_groups(classes, 0.8, 0.99, bucket=8, leaders=leaders).collect()}
        apart = sum(group.get(i, -i - 1) != group.get(lead, -lead - 1) for i, (lead, _) in enumerate(want))
        assert apart <= 2 and len({group.get(i, -i - 1) for i in range(160, 220)}) >= 30


def test_jaccard_join_of_edge_rows(spark):
    rows = edge_rows()
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in chosenpath.jaccard_join(frame(spark, rows)).collect()), key=str)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    classes = jaccard_classes([rows[i][1] for i in order])
    want = [(rows[i][0], rows[order[c]][0], n) for i, (c, n) in zip(order, classes)]
    assert got == sorted(want, key=str)


def test_one_of_each_class_stays(spark):
    rows = edge_rows()
    df = frame(spark, rows).withColumnRenamed("n_chars", "ord")
    kept = chosenpath.keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    classes = {r["class_id"] for r in chosenpath.jaccard_join(df).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(c for c in classes if c is not None)


def test_nothing_in_nothing_out(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert chosenpath.jaccard_join(empty).count() == 0
    assert chosenpath.keep_one(empty).count() == 0


def test_runs_grow_with_recall():
    assert chosenpath.runs_for(0.99, 0.8, 1) < chosenpath.runs_for(0.99, 0.8, 3) < chosenpath.runs_for(0.999, 0.8, 3)


def test_sketches_pass_pairs_at_the_threshold():
    assert chosenpath.least_agreement(0.8) == 89
    rng = np.random.default_rng(5)
    loss = cuts = 0
    for _ in range(20):
        a = rng.integers(0, 2**32, (2000, 64), dtype=np.uint32)
        b = np.where(rng.random((2000, 64)) < 0.8, a, rng.integers(0, 2**32, (2000, 64), dtype=np.uint32))
        bits = 128 - np.bitwise_count((chosenpath._sketches(a) ^ chosenpath._sketches(b)).view(np.uint64)).sum(axis=1).astype(int)
        loss, cuts = loss + (bits < chosenpath.least_agreement(0.8)).sum(), cuts + (bits < 99).sum()
    assert loss == 0 < cuts  # 99 is the cutoff of 128 independent bits


def test_runs_reach_the_recall_with_one_signature():
    runs = chosenpath.runs_for(0.99, 0.8, 6)
    rng = np.random.default_rng(6)
    agree = rng.binomial(64, 0.8, 200_000)
    p = np.ones(len(agree))
    for _ in range(6):
        p = 1 - (1 - p / (0.8 * 64)) ** agree
    assert (1 - (1 - p) ** runs).mean() > 0.9895 > (1 - (1 - p) ** 18).mean()
    assert chosenpath.recall_of(runs - 1, 0.8, 0.8, 6) < 0.99 <= chosenpath.recall_of(runs, 0.8, 0.8, 6)


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    b = np.concatenate((a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)))
    h = np.concatenate((np.sort(a), np.sort(b)))
    sig = chosenpath.signatures(np.array([0, 900, 1800]), h, 512)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.06


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)] + [(7, 7)]
    lead = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            lead[a] = lead[b] = min(lead[a], lead[b])
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in lead.items() if x in got} and set(lead) - set(got) <= {a for a, b in edges if a == b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- greedy string tiling -----------------------------------------------------


def brute_tiles(item, text, shortest):
    """Share of the item under tiles, the longest first, by trying everything."""
    used_i, used_t, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n] and a + n not in used_i and b + n not in used_t:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < shortest:
            return total
        used_i.update(range(a, a + n))
        used_t.update(range(b, b + n))
        total += n


def test_tiles_match_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        item = np.array([rng.randrange(1, 9) for _ in range(rng.randrange(5, 30))], np.uint64)
        text = np.array([rng.randrange(1, 9) for _ in range(rng.randrange(5, 40))], np.uint64)
        if rng.random() < 0.7:
            cut = rng.randrange(len(item))
            text = np.concatenate((text[:10], item[cut:], text[10:], item[:cut]))
        tiles = decontam.greedy_tiles(item, text, 3)
        assert len({i for a, _, n in tiles for i in range(a, a + n)}) == sum(n for *_, n in tiles) == len({i for _, b, n in tiles for i in range(b, b + n)})
        assert all((item[a : a + n] == text[b : b + n]).all() and n >= 3 for a, b, n in tiles)
        # where ties are broken another way, a token or two may differ
        assert abs(sum(n for *_, n in tiles) - brute_tiles(item.tolist(), text.tolist(), 3)) <= 4


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEM = "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda mu."


def test_passages_are_found_whole_reordered_and_restyled(spark):
    w = ITEM.split()
    texts = [
        "noise " * 30 + ITEM + " more noise", "only noise here and nothing else at all", "so " + " ".join(w[6:]) + " then " + " ".join(w[:6]),
        ITEM.upper().replace(",", " ;"), " ".join(w[:5]) + " stop", None, "", ITEM,
    ]
    got = {r["doc_id"]: r for r in decontam.contamination(frame(spark, texts), bench(spark, [(1, ITEM), (2, "short item"), (3, None), (4, ""), (1, ITEM)])).collect()}
    assert [got[i]["contaminated"] for i in range(8)] == [True, False, True, True, False, False, False, True]
    assert got[0]["coverage"] == got[2]["coverage"] == got[3]["coverage"] == 1.0
    assert [got[i]["item_ids"] for i in (0, 1)] == [[1], []] and got[1]["item_id"] is None


def test_blocks_of_the_benchmark_give_the_same(spark):
    texts = random_texts(6, 40, 300)
    items = bench(spark, [(i, " ".join(t.split()[:30])) for i, t in enumerate(texts[::4])])
    docs = frame(spark, texts)
    keys = lambda df: sorted((r["doc_id"], r["item_ids"], r["item_id"], r["coverage"]) for r in df.collect())
    whole = keys(decontam.contamination(docs, items))
    blocks = decontam.contamination(docs, items, block_tokens=40)
    assert whole == keys(blocks)
    # one block at a time: the passes before the last one are tables
    assert blocks._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    for i, t in enumerate(texts):
        tokens = {w: np.uint64(k + 1) for k, w in enumerate(sorted({x for y in texts for x in y.split()}))}
        for j, item in enumerate(texts[::4]):
            item = item.split()[:30]
            if len(item) >= 5:
                tiles = decontam.greedy_tiles(np.array([tokens[x] for x in item]), np.array([tokens[x] for x in t.split()]), 5)
                assert (j in whole[i][1]) == (sum(n for *_, n in tiles) >= 0.5 * len(item))


def test_clean_documents_stay_with_all_columns(spark):
    docs = frame(spark, edge_rows() + [(50, ITEM, "en", "a")]).withColumnRenamed("n_chars", "coverage").withColumnRenamed("source", "item_id")
    kept = decontam.keep_uncontaminated(docs, bench(spark, [(1, ITEM)]))
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontam.contamination(docs, bench(spark, [])).where("contaminated").count() == 0
    assert decontam.contamination(docs.limit(0), bench(spark, [(1, ITEM)])).count() == 0
