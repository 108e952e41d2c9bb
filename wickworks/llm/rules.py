"""Quality rules with risk-controlled thresholds.

Each rule compares a ratio of a text's counts with a cutoff.  Labelled texts
are split by length into strata and, by a hash of their id, into a quarter that
orders the settings (a rule and a cutoff) of each stratum and a holdout of the
rest that tests them.  The order is that of the good texts lost, then of the bad
ones caught; settings that don't catch more bad than good ones are left out.
Step k of a stratum's sequence rejects what any of its first k settings does.
Going along it, a step is certified while the exact binomial test over the
holdout rejects that it throws away more than ``alpha`` of the good texts, at
level ``delta / strata``; the first failure ends the sequence.  The holdout has
no part in the order, so a fixed sequence needs no further correction within a
stratum, and Bonferroni's is taken over the strata: with probability
``1 - delta``, no stratum loses more than ``alpha`` of its good texts to the
rules together, whichever certified step is used.  Of them, the one is used that
catches the most bad texts beyond the good ones.  A verdict needs some
``log(delta / strata) / log(1 - alpha)`` good texts in the stratum's holdout.

Everything here is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.base import written

SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30  # percent
# Number of words from which each stratum after the first begins.
STRATA = (100, 400, 2000)
# Rule: (numerator, does a high ratio fire?, cutoffs from the mildest). The denominator is n_words.
RULES = {
    "symbols": ("n_symbols", True, (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines", True, (0.2, 0.1, 0.05, 0.02, 0.01, 0.005)),
    "short_words": ("word_chars", False, (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)),
    "long_words": ("word_chars", True, (20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.0)),
    "repeats": ("n_repeat_words", True, (0.25, 0.2, 0.15, 0.1, 0.05, 0.02)),
}
ALPHA, DELTA = 0.02, 0.05


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Number of words in windows of 8 that occur twice or more in the array."""

    def repeated(keys: Column) -> Column:
        ordered = F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _let(ordered, lambda o: F.filter(o, lambda x, j: (x["h"] == F.get(o, j - 1)["h"]) | (x["h"] == F.get(o, j + 1)["h"])))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        steps = _let(places, lambda p: F.transform(p, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - i, F.lit(WINDOW)))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def keys(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    count = _let(_let(hashes, keys), lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(repeated(k)))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0))


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of each row.

    A null text counts as empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def counts(words: Column) -> Column:
        lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(HAS_WORD))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    words = F.filter(F.split(body, SPACE, -1), lambda w: w != "")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return docs.select(F.col(doc_id).alias("doc_id"), _let(words, counts).alias("c")).select("doc_id", "c.*").withColumn("base_failed", failed)


def stratum() -> Column:
    return sum(((F.col("n_words") >= least).cast("int") for least in STRATA), F.lit(0))


def _ratio(rule: str) -> Column:
    return F.col(RULES[rule][0]) / F.greatest(F.col("n_words"), F.lit(1))


def _fires(rule: str, cutoff: Column) -> Column:
    return _ratio(rule) >= cutoff if RULES[rule][1] else _ratio(rule) <= cutoff


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) for a binomial of chance p; 1 where k is over the mean."""
    odds = math.log(p / (1 - p))
    start = F.struct((n * math.log(1 - p)).cast("double").alias("term"), F.lit(0.0).alias("sum"))

    def step(a: Column, i: Column) -> Column:
        following = a["term"] + F.log((n - i).cast("double") / (i + 1)) + odds
        return F.struct(F.coalesce(following, F.lit(0.0)).alias("term"), (a["sum"] + F.exp(a["term"])).alias("sum"))

    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, step, lambda a: a["sum"]))


def _orders(doc_id: Column) -> Column:
    """Does a labelled text order the settings (a quarter of them), or is it of the holdout?"""
    return F.substring(F.md5(doc_id.cast("string")), 1, 1) < "4"


def certified(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n_good, good, bad): the settings in use, where there are any.

    ``labelled``: ``features`` with ``quality`` 1 or 0; texts that fail the base
    rules don't count.  n_good: good texts of the stratum's holdout; good, bad:
    how many good and bad ones of it the certified settings together throw away.
    Of a rule's settings the harshest is returned, which holds the others.
    """
    settings = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), _fires(rule, F.lit(c)).alias("fires")) for rule, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts)])
    counted = labelled.where("NOT base_failed").select(stratum().alias("stratum"), (F.col("quality") == 1).alias("is_good"), _orders(F.col("doc_id")).alias("orders"), F.filter(settings, lambda s: s["fires"]).alias("fired"))
    tried = counted.where("orders").select("stratum", "is_good", F.explode("fired").alias("f")).groupBy("stratum", "f.rule", "f.i", "f.cutoff")
    sums = tried.agg(F.count_if("is_good").alias("lost"), F.count_if(~F.col("is_good")).alias("caught")).where("caught > lost")
    steps = sums.withColumn("step", F.row_number().over(Window.partitionBy("stratum").orderBy("lost", F.desc("caught"), "rule", "i")))
    # a text leaves at the first step that rejects it; broadcast: a row a stratum, of all settings at most
    paths = steps.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "rule", "i"), "step"))).alias("path"))
    left = F.array_min(F.transform("fired", lambda f: F.col("path")[F.concat_ws(":", f["rule"], f["i"])]))
    holdout = counted.where("NOT orders").join(F.broadcast(paths), "stratum").select("stratum", "is_good", left.alias("step"))
    left_at = holdout.groupBy("stratum", "step").agg(F.count_if("is_good").alias("g"), F.count_if(~F.col("is_good")).alias("b"))
    sizes = left_at.groupBy("stratum").agg(F.sum("g").alias("n_good"))
    along = Window.partitionBy("stratum").orderBy("step")
    totals = steps.join(left_at, ["stratum", "step"], "left").withColumns({"good": F.sum(F.coalesce("g", F.lit(0))).over(along), "bad": F.sum(F.coalesce("b", F.lit(0))).over(along)}).join(sizes, "stratum")
    passes = binomial_cdf(F.col("good"), F.col("n_good"), alpha) <= delta / (len(STRATA) + 1)
    tested = totals.withColumn("certified", F.min(passes).over(along))
    worth = F.struct((F.col("bad") - F.col("good")).alias("gain"), (-F.col("step")).alias("early"), "n_good", "good", "bad")
    best = tested.where("certified AND bad > good").groupBy("stratum").agg(F.max(worth).alias("b"))
    used = steps.join(best, "stratum").where("step <= -b.early").groupBy("stratum", "rule").agg(F.max_by("cutoff", "i").alias("cutoff"), F.first("b").alias("b"))
    return used.select("stratum", "rule", "cutoff", "b.n_good", "b.good", "b.bad")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """``features`` and ``kept`` of each row of ``docs``.

    kept is false if base_failed, else true unless a rule fires at its certified
    cutoff in the text's stratum.  Where too few labels certify a step, the
    rules rest.  Label rows with a null are ignored; a document labelled more
    than once is good if all its labels are.
    """
    found = written(features(docs, doc_id, text), "rule-features")
    known = labels.select(F.col(doc_id).alias("of"), F.col(quality).alias("quality")).dropna().groupBy("of").agg(F.min("quality").alias("quality"))
    labelled = found.join(known, F.col("doc_id") == F.col("of")).drop("of")
    cutoffs = certified(labelled, alpha, delta).collect()  # rules x strata rows at most
    caught = F.lit(False)
    for c in cutoffs:
        caught = caught | ((stratum() == c["stratum"]) & _fires(c["rule"], F.lit(c["cutoff"])))
    return found.withColumn("kept", ~F.col("base_failed") & ~caught)


def op5_sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """DuckDB SQL of op5's rows."""
    chance, level = alpha, delta / (len(STRATA) + 1)
    rules = " UNION ALL ".join(f"SELECT '{r}' AS rule, {i} AS i, CAST({c} AS DOUBLE) AS cutoff" for r, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts))
    ratio = "CASE rule " + " ".join(f"WHEN '{r}' THEN CAST({col} AS DOUBLE) / greatest(n_words, 1)" for r, (col, _, _) in RULES.items()) + " END"
    fires = "CASE WHEN rule IN (" + ", ".join(f"'{r}'" for r, (_, high, _) in RULES.items() if high) + f") THEN {ratio} >= cutoff ELSE {ratio} <= cutoff END"
    band = " + ".join(f"CAST(n_words >= {n} AS INT)" for n in STRATA)
    return f"""
    WITH t AS (
      SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
    ), w AS (
      SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t
    ), g AS (
      SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS gram FROM w, unnest(range(1, len(words) - {WINDOW - 2})) AS u(i) WHERE len(words) >= {WINDOW}
    ), twice AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1
    ), rep AS (
      SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM twice, unnest(range({WINDOW})) AS u(j) GROUP BY r
    ), c AS (
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)
    ), f AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, {band} AS stratum FROM c
    ), rules AS ({rules}
    ), known AS (
      SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
    ), l AS (
      SELECT row_number() OVER () AS row, f.*, quality = 1 AS is_good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '4' AS orders FROM f JOIN known USING (doc_id) WHERE NOT base_failed
    ), hits AS (
      SELECT row, stratum, is_good, orders, rule, i, cutoff FROM l, rules WHERE {fires}
    ), steps AS (
      SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY lost, caught DESC, rule, i) AS step
      FROM (SELECT stratum, rule, i, cutoff, count(*) FILTER (WHERE is_good) AS lost, count(*) FILTER (WHERE NOT is_good) AS caught FROM hits WHERE orders GROUP BY ALL)
      WHERE caught > lost
    ), gone AS (
      SELECT h.row, h.stratum, h.is_good, min(step) AS step FROM hits h JOIN steps USING (stratum, rule, i) WHERE NOT orders GROUP BY ALL
    ), s AS (
      SELECT stratum, step, (SELECT count(*) FROM l WHERE NOT orders AND is_good AND l.stratum = steps.stratum) AS n,
        (SELECT count(*) FROM gone g WHERE g.stratum = steps.stratum AND g.step <= steps.step AND is_good) AS good,
        (SELECT count(*) FROM gone g WHERE g.stratum = steps.stratum AND g.step <= steps.step AND NOT is_good) AS bad
      FROM steps
    ), p AS (
      SELECT *, CASE WHEN good > n * {chance} THEN 1.0 ELSE list_sum(list_transform(range(good + 1), lambda x: exp(lgamma(n + 1) - CASE WHEN x > 0 THEN lgamma(x + 1) ELSE 0 END - CASE WHEN n > x THEN lgamma(n - x + 1) ELSE 0 END + x * ln({chance}) + (n - x) * ln(1 - {chance})))) END <= {level!r} AS passes FROM s
    ), ok AS (
      SELECT *, bool_and(passes) OVER (PARTITION BY stratum ORDER BY step) AS certified FROM p
    ), best AS (
      SELECT stratum, step AS last, row_number() OVER (PARTITION BY stratum ORDER BY bad - good DESC, step) AS n FROM ok WHERE certified AND bad > good
    ), caught AS (
      SELECT stratum, rule, cutoff FROM steps JOIN best USING (stratum) WHERE best.n = 1 AND step <= last
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT EXISTS (SELECT 1 FROM caught WHERE caught.stratum = f.stratum AND {fires}) AS kept
    FROM f
    """
