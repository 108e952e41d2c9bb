import hashlib
import math
import random
from collections import Counter

import numpy as np

from tests.llm.cases import edge_rows, frame
from wickworks.llm import improbable
from wickworks.llm.base import mix

SIZES = (4, 8, 16, 32)


def size_class(n):
    return max([0] + [k for k in range(1, 4) if n >= 8 * SIZES[k]])


def level(window):
    f = lambda c: round(c * math.log2(max(c, 1)) * 65536)
    return 1000 - sum(f(c) for c in Counter(window).values()) * 1000 // f(len(window))


def brute_counts(bodies):
    out = np.zeros((4, 1001), np.int64)
    for b in bodies:
        k = size_class(len(b))
        for i in range(len(b) - SIZES[k] + 1):
            out[k][level(b[i : i + SIZES[k]])] += 1
    return out


def brute_digest(body, ranks):
    if not body:
        return np.zeros((0, 256), np.uint8)
    k = size_class(len(body))
    w = SIZES[k]
    if len(body) < w:
        hashes = [int(mix(np.array([int.from_bytes(body, "little") | len(body) << 32], np.uint64))[0])]
    else:
        rank = [ranks[k][level(body[i : i + w])] for i in range(len(body) - w + 1)]
        won = Counter()
        for i in range(max(1, len(rank) - w + 1)):
            part = rank[i : i + w]
            won[i + part.index(min(part))] += 1
        places = sorted(p for p, n in won.items() if n >= w // 4) or [min(p for p, n in won.items() if n == max(won.values()))]
        hashes = []
        for p in places:
            h = np.array([w], np.uint64)
            for j in range(0, w, min(8, w)):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(int.from_bytes(body[p + j : p + j + min(8, w)], "little")))
            if int(h[0]) not in hashes:
                hashes.append(int(h[0]))
    bits = np.zeros((-(-len(hashes) // 160), 2048), bool)
    for i, h in enumerate(hashes):
        for j in range(5):
            bits[i // 160][(h >> 11 * j) % 2048] = True
    return np.packbits(bits, axis=1)


def texts(seed, n=40):
    rng = random.Random(seed)
    out = ["", None, "a", "abc", "abcd", "é" * 3, "x" * 700, " " * 40, "ab" * 200, "one two three four five six"]
    for _ in range(n):
        out.append(" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü.") for _ in range(rng.randrange(1, 9))) for _ in range(rng.choice((3, 20, 60, 150)))))
    return out


def test_entropy_levels_of_every_window():
    rng = random.Random(5)
    for size in SIZES:
        for n in (0, size - 1, size, size + 1, 300, 9000):
            body = bytes(rng.choice(b"aab \n\xff") for _ in range(n))
            got = improbable.entropy_levels(np.frombuffer(body, np.uint8), size)
            assert list(got) == [level(body[i : i + size]) for i in range(n - size + 1)]


def test_digests_same_as_brute_force(spark):
    all_texts = texts(3)
    bodies = [(t or "").encode() for t in all_texts]
    counts = improbable.level_counts(frame(spark, all_texts).select("text"))
    assert (counts == brute_counts(bodies)).all()
    ranks = improbable.rarity(counts)
    for got, body in zip(improbable.digests(bodies, ranks), bodies):
        assert np.array_equal(got, brute_digest(body, ranks))
    stored = {r["doc_id"]: r for r in improbable.fingerprint(frame(spark, all_texts)).collect()}
    assert all(bytes(stored[i]["fingerprint"]) == brute_digest(b, ranks).tobytes() and stored[i]["n_chars"] == len(all_texts[i] or "") for i, b in enumerate(bodies))


def test_every_document_has_its_edited_text(spark):
    rows = [(i * 3, t, "en", "s") for i, t in enumerate(texts(4))] + [r for r in edge_rows() if r[0] is None]
    got = improbable.with_edits(frame(spark, rows), np.tile(np.arange(1001), (4, 1))).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = []
    for a, b in zip(ordered, ordered[1:] + ordered[:1]):
        t, n = a[1] or "", len(a[1] or "") // 4
        want.append((a[0], len(t), hashlib.sha256((t[: len(t) - n] + (b[1] or "")[:n]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    one = improbable.with_edits(frame(spark, ["one text only, followed by itself"])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert improbable.with_edits(frame(spark, ["x"]).limit(0)).count() == 0


def test_likeness_tells_edits_from_strangers(spark):
    all_texts = [t for t in texts(6, n=120) if len(t or "") > 150 and len(set(t)) > 5]
    bodies = [t.encode() for t in all_texts]
    ranks = improbable.rarity(brute_counts(bodies[:10]))
    whole = improbable.digests(bodies, ranks)
    edits = improbable.digests([improbable.edited(a, b).encode() for a, b in zip(all_texts, all_texts[1:])], ranks)
    near = [improbable.likeness(a, b) for a, b in zip(whole, edits)]
    far = [improbable.likeness(a, b) for a, b in zip(whole, whole[1:])]
    assert min(near) > 0.4 > 0.3 > max(far) and all(improbable.likeness(a, a.copy()) == 1 for a in whole)
    none = np.zeros((0, 256), np.uint8)
    assert improbable.likeness(none, none) == 1 and improbable.likeness(none, whole[0]) == 0
    assert improbable.likeness(whole[0], edits[0]) == improbable.likeness(edits[0], whole[0])
