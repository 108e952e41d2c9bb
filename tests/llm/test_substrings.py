import hashlib

import pytest

from tests.llm.cases import edge_rows, frame, random_texts, repeated_bytes, repeated_word_windows
from wickworks.llm import blocks, suffix


def by_row(rows, *columns):
    return sorted([tuple(r[c] for c in columns) for r in rows], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows_match_brute_force(spark, seed):
    texts = random_texts(seed)
    got = blocks.dedup_substrings(frame(spark, texts)).collect()
    want = repeated_word_windows(list(enumerate(texts)))
    assert any(w[1] for w in want.values())
    assert by_row(got, "doc_id", "n_words", "n_removed", "text") == sorted([(i, w[0], w[1], w[2].decode()) for i, w in want.items()], key=str)


def test_word_windows_of_edge_rows(spark):
    rows = edge_rows()
    got = blocks.dedup_substrings(frame(spark, rows)).collect()
    want = repeated_word_windows([r[:2] for r in rows])
    assert by_row(got, "doc_id", "n_words", "n_removed", "text") == sorted([(rows[i][0], w[0], w[1], w[2].decode()) for i, w in want.items()], key=str)


def test_word_windows_inside_one_long_text(spark):
    body = " ".join(f"v{i % 977}" for i in range(60_000))
    got = blocks.dedup_substrings(frame(spark, [body])).first()
    want = repeated_word_windows([(0, body)])[0]
    assert (got["n_words"], got["n_removed"], got["text"].encode()) == want


def test_spans_cover_what_is_removed(spark):
    for r in blocks.dedup_substrings(frame(spark, random_texts(3))).collect():
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"]


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"local_hot": 1, "hot": 1}), (4, {"local_hot": 0, "hot": 0}), (5, {"local_hot": 100, "hot": 2})])
def test_byte_strings_match_brute_force(spark, seed, options):
    texts = random_texts(seed)
    got = suffix.dedup_suffixes(frame(spark, texts), **options).collect()
    want = repeated_bytes(texts)
    assert any(w[1] for w in want)
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "kept", "spans") == sorted([(i, w[0], w[1], w[2], w[3]) for i, w in enumerate(want)], key=str)


def test_byte_strings_of_edge_rows(spark):
    rows = edge_rows()
    got = suffix.dedup_suffixes(frame(spark, rows)).collect()
    want = repeated_bytes([r[1] for r in rows])
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "kept", "spans") == sorted([(r[0], *w) for r, w in zip(rows, want)], key=str)


def test_byte_strings_over_the_seam_of_a_very_long_text(spark):
    import random

    rng = random.Random(7)
    noise = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    passage = noise(700)
    body = noise(880_000) + passage + noise(900_000)
    got = {r["doc_id"]: r for r in suffix.dedup_suffixes(frame(spark, [body, noise(500) + passage])).collect()}
    size = len(passage.encode())
    assert got[0]["n_removed"] >= size and got[0]["n_removed"] <= size + 8
    assert got[1]["n_removed"] == got[0]["n_removed"]


def test_deep_shallow_order_and_prefixes():
    import random

    rng = random.Random(3)
    for _ in range(60):
        stem = bytes(rng.choice(b"ab") for _ in range(30))
        strings = [stem[: rng.randrange(31)] + bytes(rng.choice(b"abc") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(2, 40))]
        strings += strings[:3]
        order, lcp = suffix.deep_shallow(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        for a, b, n in zip(order, order[1:], lcp):
            assert strings[a][:n] == strings[b][:n] and (strings[a][n : n + 1] != strings[b][n : n + 1] or n == len(strings[a]) == len(strings[b]))


def test_reach_of_many_equals_reach_by_pairs(monkeypatch):
    import random

    rng = random.Random(5)
    gram = b"g" * suffix.GRAM
    left, right = bytes(rng.choice(b"xy") for _ in range(200)), bytes(rng.choice(b"xy") for _ in range(200))
    contexts = []
    for _ in range(40):
        a, b = rng.randrange(161), rng.randrange(161)
        contexts.append((left[:a] + b"#%d" % rng.randrange(99), gram + right[:b] + b"#%d" % rng.randrange(99)))
    contexts = [(x[: suffix.BACK], y[: suffix.LENGTH]) for x, y in contexts]
    pairs = suffix.reach(contexts)
    monkeypatch.setattr(suffix, "PAIRED", 3)
    assert suffix.reach(contexts) == pairs


def test_empty_tables_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, ord int, th string, at int")
    assert blocks.dedup_substrings(empty).count() == 0
    assert suffix.dedup_suffixes(empty).count() == 0
    named = spark.createDataFrame([(1, "a b", 3, "x", 4)], empty.schema)
    assert blocks.dedup_substrings(named).first()["text"] == "a b"
    assert hashlib.sha256(suffix.dedup_suffixes(named).first()["kept"]).hexdigest() == hashlib.sha256(b"a b").hexdigest()
