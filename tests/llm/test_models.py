import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_rows, frame
from wickworks.llm import langid, resample, rules

# --- language ID --------------------------------------------------------------


def all_segmentations(word, p):
    """Sum over all segmentations of the product of the pieces' probabilities."""
    if not word:
        return 1.0
    return sum(p[word[:i]] * all_segmentations(word[i:], p) for i in range(1, len(word) + 1) if word[:i] in p)


def test_forward_sums_all_segmentations_and_counts_their_pieces():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"]
    p = {n: (i + 1) / 40 for i, n in enumerate(names)}
    pieces = langid.Pieces(names)
    table = np.array([*p.values(), 0.0, 1e-3])[:, None]
    words = ["a", "ab", "abba", "babab", "aabab"]
    got = langid.log_likelihoods(words, pieces, table)[:, 0]
    want = [all_segmentations("▁" + w, p) for w in words]
    assert np.allclose(np.exp(got), want)
    counts = langid.expected_counts(words, np.ones(len(words)), pieces, table)
    for i, n in enumerate(names):  # the derivative of the log likelihood, times p
        bumped = {**p, n: p[n] * 1.000001}
        slope = sum(math.log(all_segmentations("▁" + w, bumped)) - math.log(all_segmentations("▁" + w, p)) for w in words) / 1e-6
        assert abs(counts[i] - slope) < 1e-3


def test_long_and_unknown_words_stay_finite():
    pieces = langid.Pieces(["▁", "a"])
    table = np.array([0.5, 0.4, 0.0, 1e-6])[:, None]
    got = langid.log_likelihoods(["a" * 5000, "é" * 300, "aé"], pieces, table)[:, 0]
    assert np.isfinite(got).all() and abs(got[0] - (math.log(0.5) + 5000 * math.log(0.4))) < 1e-6 * 5000


def test_long_words_count_in_full():
    pieces = langid.Pieces(["▁", "a", "b", "ab", "ba"])
    table = np.array([0.1, 0.01, 0.02, 0.003, 0.004, 0.0, 1e-9])[:, None]
    words = ["ab" * 200, "é" * 300 + "ab", "abba" * 20]  # sums far below the smallest double
    counts = langid.expected_counts(words, np.array([1.0, 2.0, 3.0]), pieces, table)
    assert abs(counts[0] - 6) < 1e-9 and counts[-1] == pytest.approx(600)
    for i in range(5):  # the derivative of the log likelihood, times p
        bumped = table.copy()
        bumped[i] *= 1.0001
        slope = (langid.log_likelihoods(words, pieces, bumped) - langid.log_likelihoods(words, pieces, table))[:, 0] @ [1, 2, 3] / 1e-4
        assert counts[i] == pytest.approx(slope, rel=1e-3)
    stretched = langid.expected_counts(["a" * 5000], np.ones(1), langid.Pieces(["▁", "a"]), np.array([0.5, 0.4, 0.0, 1e-6])[:, None])
    assert np.allclose(stretched, [1, 5000, 0, 0])


def test_languages_of_long_words_are_told_apart(spark):
    rng = random.Random(4)
    token = lambda lang: "".join(rng.choice(["der", "und", "ich", "sch"] if lang == "de" else ["the", "ing", "and", "tion"]) for _ in range(25))[:70]
    rows = [(i, " ".join(token(lang) for _ in range(5)), lang, "s") for i in range(40) for lang in (("de", "en")[i % 2],)]
    got = langid.language_id(frame(spark, rows)).collect()
    assert all(r["lang_pred"] == ("de", "en")[r["doc_id"] % 2] and r["score"] > 0.9 for r in got)


def test_held_out_documents_are_told_apart(spark):
    rng = random.Random(1)
    lists = {"en": "the of and to in that is was for with on are".split(), "de": "der die und das von zu mit sich auf für ist nicht".split(), "fr": "le de la et les des en un que est pour dans".split()}
    rows = [(i, " ".join(rng.choice(lists[lang]) for _ in range(rng.randrange(5, 30))) + ".", lang, "s") for i, lang in enumerate(rng.choice(list(lists)) for _ in range(300))]
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 !! 4", "fr", "s"), (1003, "the of and", None, None), (None, "der die und", "de", "s"), (1004, "the " * 50_000, "en", "s")]
    got = {r["doc_id"]: r for r in langid.language_id(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, lang, _ in rows[:300]:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None, 1004)] == ["und", "und", "und", "en", "de", "en"]
    assert got[1000]["score"] == 0 and got[None]["held_out"] is False


def test_labels_of_the_asked_are_not_read(spark):
    rows = [(i, "alpha beta" if i % 2 else "gamma delta", "x" if i % 2 else "y", "s") for i in range(40)]
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other") for i, t, lang, _ in rows]
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in df.collect())
    assert key(langid.language_id(frame(spark, rows))) == key(langid.language_id(frame(spark, other)))


def test_language_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.language_id(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], empty.schema)
    assert langid.language_id(unlabelled).first()["lang_pred"] == "und"


def test_clashing_columns_are_kept(spark):
    docs = frame(spark, [(i, "the of and" if i % 2 else "der die das", "en" if i % 2 else "de", "s") for i in range(30)] + [(90, None, "en", "s")]).withColumnRenamed("n_chars", "score").withColumnRenamed("source", "lang_pred")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 30 and {r["lang_pred"] for r in kept.collect()} == {"s"}


# --- quality rules --------------------------------------------------------------


def brute_features(text):
    text = text or ""
    w = text.encode().split()
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_features_match_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "bé", "c#", "<d>", "e\nf", "\n\n", "g\x0bh"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["x y z " * 5, "one " * 40, ("a b c d e f g h i " * 3) + "\n" + "q\n" * 4, "w" * 3000, " ".join(f"u{i}" for i in range(3000)) + " " + " ".join(f"u{i}" for i in range(100))]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + edge_rows()
    got = sorted([tuple(r)[:6] for r in rules.features(frame(spark, rows)).collect()], key=str)
    assert got == sorted([(r[0], *brute_features(r[1])) for r in rows], key=str)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.1), (9, 2000, 0.01), (0, 5000, 0.004), (30, 9000, 0.004), (700, 200_000, 0.004), (0, 0, 0.1)]
    for k, n, p in cases:
        got = spark.range(1).select(rules.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")).first()["x"]
        want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
        assert abs(got - want) < 1e-9


def test_few_labels_certify_nothing_and_many_do(spark):
    good, bad = "plain words in a row " * 8, "bad # % words * with $ signs " * 8
    spread = lambda t, i: " ".join(f"{w}{i}{j}" if w.isalpha() else w for j, w in enumerate(t.split()))
    def run(n):
        docs = frame(spark, [(i, spread(good if i % 4 else bad, i), "en", "s") for i in range(n)])
        labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(n)] + [(None, 1), (3, None), (n + 5, 0)], "doc_id long, quality int")
        return {r["doc_id"]: r["kept"] for r in rules.judge(docs, labels).collect()}

    assert all(run(100).values())
    kept = run(2800)
    assert all(kept[i] == bool(i % 4) for i in kept)


def labelled_texts(n=4000):
    """Texts of two strata, whose bad ones have symbols, repeated lines or short words; some good ones have a few, too."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        size = rng.choice([60, 200])
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([4, 5, 9]))) for _ in range(size)]
        kind = rng.randrange(3) if bad else 3 if rng.random() < 0.9 else rng.randrange(3)
        share = 0.4 if bad else 0.12
        if kind == 0:
            words = [w + "#%" if rng.random() < share else w for w in words]
        elif kind == 1:
            words = [w[:1] if rng.random() < share * 2 else w for w in words]
        lines = [" ".join(words[j : j + 6]) for j in range(0, size, 6)]
        if kind == 2:
            lines += lines[:1] * (8 if bad else 1)
        rows.append((i, "\n".join(lines), "en", "s"))
        if rng.random() < 0.9:
            labels.append((i, int(not bad)))
    return rows, labels


def brute_cutoffs(found, quality):
    """{stratum: settings in use} from (doc_id, counts) and labels, step by step."""
    out = {}
    ratio = lambda d, rule: d[rules.RULES[rule][0]] / max(d["n_words"], 1)
    fires = lambda d, rule, cut: ratio(d, rule) >= cut if rules.RULES[rule][1] else ratio(d, rule) <= cut
    for band in range(len(rules.STRATA) + 1):
        mine = [d for d in found if d["doc_id"] in quality and not d["base_failed"] and sum(d["n_words"] >= x for x in rules.STRATA) == band]
        first = lambda d: hashlib.md5(str(d["doc_id"]).encode()).hexdigest()[0] < "4"
        order, test = [d for d in mine if first(d)], [d for d in mine if not first(d)]
        steps = []
        for rule, (_, _, cuts) in rules.RULES.items():
            for i, cut in enumerate(cuts):
                hit = [quality[d["doc_id"]] for d in order if fires(d, rule, cut)]
                if hit.count(0) > hit.count(1):
                    steps.append((hit.count(1), -hit.count(0), rule, i, cut))
        steps.sort()
        n, best = sum(quality[d["doc_id"]] for d in test), (0, None)
        for k in range(1, len(steps) + 1):
            hit = [quality[d["doc_id"]] for d in test if any(fires(d, s[2], s[4]) for s in steps[:k])]
            good = hit.count(1)
            p = sum(math.comb(n, x) * rules.ALPHA**x * (1 - rules.ALPHA) ** (n - x) for x in range(good + 1))
            if p > rules.DELTA / (len(rules.STRATA) + 1):
                break
            if hit.count(0) - good > best[0]:
                best = (hit.count(0) - good, steps[:k])
        if best[1]:
            out[band] = [(s[2], s[4]) for s in best[1]]
    return out, fires


def test_verdicts_match_brute_force_and_sql(spark, tmp_path):
    rows, labels = labelled_texts()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in rules.judge(docs, marks).collect()}
    found = [r.asDict() for r in rules.features(docs).collect()]
    used, fires = brute_cutoffs(found, dict(labels))
    assert sorted(used) == [0, 1] and len({rule for s in used.values() for rule, _ in s}) > 1
    for d in found:
        band = sum(d["n_words"] >= x for x in rules.STRATA)
        assert got[d["doc_id"]]["kept"] == (not d["base_failed"] and not any(fires(d, *s) for s in used.get(band, []))), d
    lost = [got[i]["kept"] for i, q in labels if q and not got[i]["base_failed"]]
    caught = [got[i]["kept"] for i, q in labels if not q and not got[i]["base_failed"]]
    assert lost.count(False) <= rules.ALPHA * len(lost) and caught.count(False) > 0.5 * len(caught)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    theirs = con.sql(rules.op5_sql()).select("doc_id, kept").fetchall()
    assert sorted(theirs) == sorted((i, r["kept"]) for i, r in got.items())


def test_rules_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judge(empty, labels).count() == 0
    assert rules.judge(frame(spark, edge_rows()), labels).count() == len(edge_rows())


# --- importance resampling --------------------------------------------------------


def test_kth_largest_is_exact(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1000) for _ in range(3000)] + [5.0] * 40 + [1e-300, -1e300, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 17, 1500, 3000, len(values)):
        assert resample.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(df, "x", len(values) + 1) is None and resample.kth_largest(df, "x", 0) is None
    assert resample.kth_largest(df.limit(0), "x", 1) is None


def corpus(spark, n=400):
    rng = random.Random(4)
    good, bad = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(bad if i % 4 == 0 else good) for _ in range(60)), "en", "s") for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, n, 3)], "doc_id long, quality int")
    return rows, labels


def test_resampling_takes_the_good_ones(spark):
    rows, labels = corpus(spark)
    got = resample.resample(frame(spark, rows), labels, share=0.75).collect()
    right = sum(r["selected"] == (r["doc_id"] % 4 > 0) for r in got)
    assert len(got) == len(rows) and right >= 0.97 * len(rows)
    # by default no good one is cut off, and a few others come along
    default = resample.resample(frame(spark, rows), labels).collect()
    assert all(r["selected"] for r in default if r["doc_id"] % 4) and sum(r["selected"] for r in default) < 0.9 * len(rows)
    again = {r["doc_id"]: r["noisy"] for r in resample.resample(frame(spark, rows[::-1]), labels, share=0.75).collect()}
    assert all(abs(again[r["doc_id"]] - r["noisy"]) < 1e-9 for r in got)


def test_log_weight_is_the_ratio_of_the_models(spark):
    rows, labels = corpus(spark, 40)
    texts = resample.keyed_texts(frame(spark, rows), "doc_id", "text")
    of = resample.log_ratios(texts, labels.where("quality = 1").select(F.col("doc_id").alias("ord")), 64)
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    import pyarrow as pa

    raw, target = np.ones(64), np.ones(64)
    for i, t, *_ in rows:
        _, bucket = resample.features(pa.array([t]), 64)
        np.add.at(raw, bucket, 1)
        if i in good:
            np.add.at(target, bucket, 1)
    assert np.allclose(of, np.log(target / target.sum()) - np.log(raw / raw.sum()))


def test_resampling_of_edge_rows(spark):
    labels = spark.createDataFrame([(6, 1), (None, 1), (7, None), (11, 0)], "doc_id long, quality int")
    got = resample.resample(frame(spark, edge_rows()), labels).collect()
    assert len(got) == len(edge_rows()) and all(r["log_weight"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert sum(r["selected"] for r in got) >= round(len(got) / 2)
    assert not any(r["selected"] for r in resample.resample(frame(spark, edge_rows()), labels.limit(0)).collect())
    assert resample.resample(frame(spark, edge_rows()).limit(0), labels).count() == 0
