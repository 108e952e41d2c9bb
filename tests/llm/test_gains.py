import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.cases import edge_rows, frame, random_texts
from wickworks.llm import gains


def runs(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, share=(5, 100), least=20, buckets=10_000):
    s, t = [0] * buckets, [0] * buckets
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for f in runs(x)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for i, x in docs:
        n, found = runs(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * share[0] // share[1]])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_followed_is_the_crc_of_both():
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice((0, 1, 5, 63, 1000)))) for _ in range(40)]
    a, b = texts[:20], texts[20:]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert list(gains.followed(crc(a), np.array([len(x) for x in b]), crc(b))) == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_features_are_those_of_each_text():
    texts = ["One two, TWO three! É two", None, "", "...", "a", "a b", "0-9 x\x00y zz zz zz zz", "ÀB àb"]
    counts, found = gains.features(pa.array(texts))
    assert list(counts) == [runs(t)[0] for t in texts]
    for n in (1, 2, 3):
        want = [zlib.crc32(f.encode()) % 10_000 for t in texts for f in runs(t)[1] if f.count(" ") == n - 1]
        assert list(found[n - 1]) == want


def test_same_as_brute_force(spark):
    texts = random_texts(7, n=90)
    docs = [(i, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in edge_rows()] + [(500, texts[0]), (500, texts[0]), (501, "WORD " * 30_000)]
    target = spark.createDataFrame([(texts[5],), (None,), ("",), (texts[9].upper(),)], "text string")
    rows = frame(spark, [(i, t, "en", "s") for i, t in docs])
    for share in ((5, 100), (1, 2), (1, 1), (0, 1)):
        got = gains.resampled(rows, target, keep=["doc_id"], share=share).select("doc_id", "n_features", "weight", "score", "rank")
        assert key(map(tuple, got.collect())) == key(brute(docs, [r[0] for r in target.collect()], share))


def test_empty_tables_and_clashing_columns(spark):
    docs = frame(spark, ["a b c " * 10, "d e f " * 10]).withColumnRenamed("lang", "Score").withColumnRenamed("source", "c0")
    none = spark.createDataFrame([], "text string")
    drawn = gains.resampled(docs, none, share=(1, 2))
    assert drawn.columns == ["doc_id", "text", "c0", "n_chars", *gains.NEW]
    assert sorted(str(r["rank"]) for r in drawn.collect()) == ["1", "None"]
    assert gains.resampled(docs.limit(0), docs.select("text")).count() == 0
