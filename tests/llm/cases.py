"""Inputs and brute-force versions that the tests share."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WS = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


def frame(spark, texts, schema=SCHEMA):
    """Documents from texts, or from (doc_id, text, lang, source) tuples."""
    rows = [t if isinstance(t, tuple) else (i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema).repartition(3)


def random_texts(seed, n=60, vocabulary=400, longest=120):
    """Texts with exact and near copies, shared passages and repeats inside."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = [word() for _ in range(45)]
    out = []
    for i in range(n):
        body = [word() for _ in range(rng.randrange(1, longest))]
        if i % 7 == 3 and out:
            body = rng.choice(out).split()
        if i % 7 == 5 and out:
            body = rng.choice(out).split()
            body[rng.randrange(len(body))] = "changed"
        if i % 5 == 2:
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        if i % 11 == 4:
            body = body + body
        out.append(" ".join(body))
    return out


def edge_rows():
    """Null, empty and blank texts, null keys, repeated rows, ties."""
    long_run = " ".join(f"x{i}" for i in range(40))
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "b"), (None, long_run, "en", "a"), (None, long_run, "en", "a"),
        (5, long_run, "de", None), (5, long_run, "de", None), (6, long_run + " y", None, "é"), (7, "one", "en", "b"), (8, "one", "en", "b"), (9, "a b c d", "fr", ""),
        (10, "...!! 123", "en", "a"), (11, "x" * 5000, "en", "a"), (12, long_run + "\n" + long_run, "en", "a"),
    ]


def repeated_word_windows(docs, window=20):
    """{index: (n_words, n_removed, kept)} of (doc_id, text) rows; null ids last."""
    order = {i: (d is None, d or 0) for i, (d, _) in enumerate(docs)}
    first = {}
    split = [words(t) for _, t in docs]
    for i in sorted(order, key=order.get):
        for s in range(len(split[i]) - window + 1):
            key = tuple(split[i][s : s + window])
            first[key] = min(first.get(key, (order[i], s)), (order[i], s))
    out = {}
    for i, w in enumerate(split):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (order[i], s):
                gone.update(range(s, s + window))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def repeated_bytes(texts, length=200):
    """[(n_bytes, n_removed, kept, spans)] of each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[s : s + length] for b in bodies for s in range(len(b) - length + 1))
    out = []
    for b in bodies:
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mark[s : s + length] = b"\1" * length
        spans, begin = [], None
        for i, m in enumerate([*mark, 0]):
            if m and begin is None:
                begin = i
            if not m and begin is not None:
                spans.append([begin, i])
                begin = None
        out.append((len(b), sum(mark), bytes(c for c, m in zip(b, mark) if not m), spans))
    return out


def shingle_set(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard_classes(texts, threshold=0.8):
    """[(class: least index linked over links, number of links)] of each text."""
    sets = [shingle_set(t) for t in texts]
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    common = Counter((a, b) for at in inverted.values() for a in at for b in at if a < b)
    links = [p for p, c in common.items() if c >= threshold * (len(sets[p[0]]) + len(sets[p[1]]) - c) - 1e-9]
    lead, count = list(range(len(texts))), Counter(x for p in links for x in p)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(lead[a], lead[b])
            changed |= lead[a] != low or lead[b] != low
            lead[a] = lead[b] = low
    return [(lead[i], count[i]) for i in range(len(texts))]
