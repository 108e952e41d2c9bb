"""Line dedup by winnowing.

Each ``gram`` consecutive lines have a hash; in each window of ``window`` such
hashes the least is chosen as a fingerprint, so that any repeat of
``gram + window - 1`` lines or more shares one (the guarantee of winnowing).
A chosen place is one row, however many windows chose it.  Places with equal
fingerprints are candidates; a place is extended over the lines before and
after it to the windows that chose it, and joined with the earliest place that
agrees in these lines too.  Adjoining matches grow into the repeated runs, of
which the earliest copy stays and later ones go.

Shorter runs count too from ``long_words`` words on: each such run is its own
fingerprint, as winnowing of grams of its length in windows of 1.

A fingerprint that very many lines share is dealt by document into ``DEALS``
parts before every shuffle, and each part is aggregated first.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import hidden, row_order, shown, written

HAS_WORD = r"[^\x20\x09-\x0D]"
# Number of words from which a run is long enough, however few its lines.
LONG_WORDS = 50
# Parts of a key that many places share.
DEALS = 16


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def text_lines(text: Column) -> Column:
    r"""\n-split lines as structs (no, line); null text as empty."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line, no: F.struct(no.alias("no"), line.alias("line")))


def _full_lines(text: Column) -> Column:
    return F.filter(text_lines(text), lambda x: x["line"].rlike(HAS_WORD))


def fingerprints(docs: DataFrame, gram: int, window: int, doc_id: str = "doc_id", text: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """A row per chosen place.

    (ord, th): the document; fp, at: the fingerprint and the number of its
    first line among those with a word; size: lines of the runs it stands for;
    ways: for each window that chose it the lines between the window's begin
    and the place, and two hashes of the fingerprint extended to that window.
    """
    span = gram + window - 1
    n_words = lambda line: F.lit(0) if long_words is None else F.regexp_count(line, F.lit(f"{HAS_WORD}+"))
    hashed = F.transform(_full_lines(F.col(text)), lambda x: F.struct(F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b"), n_words(x["line"]).alias("n")))

    def from_to(last: Column) -> Column:
        return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def extended(a: Column, at: Column, before: int, size: int) -> Column:
        lines = [F.get(a, at - before + m) for m in range(size)]
        return F.struct(F.lit(before).alias("before"), F.xxhash64(F.lit(size), *[x["a"] for x in lines]).alias("k1"), F.xxhash64(F.lit(-size), *[x["b"] for x in lines]).alias("k2"))

    def place(fp: Column, at: Column, size: int, ways: Column) -> Column:
        return F.struct(fp.alias("fp"), at.alias("at"), F.lit(size).alias("size"), ways.alias("ways"))

    def chosen(a: Column) -> Column:
        grams = F.transform(from_to(F.size(a) - gram), lambda i: F.xxhash64(*[F.get(a, i + m)["a"] for m in range(gram)]))

        def places(g: Column) -> Column:
            def least(s: Column) -> Column:  # of equal hashes the rightmost
                return -F.array_min(F.array(*[F.struct(F.get(g, s + j).alias("fp"), (-(s + j)).alias("back")) for j in range(window)]))["back"]

            def ways(at: Column, of: Column) -> Column:
                each = [F.when(F.get(of, F.when(at >= d, at - d).otherwise(F.lit(-1))) == at, extended(a, at, d, span)) for d in range(window)]
                return F.filter(F.array(*each), lambda w: w.isNotNull())

            return _let(
                F.transform(from_to(F.size(a) - span), least),
                lambda of: F.transform(F.array_distinct(of), lambda at: place(F.get(g, at), at, span, ways(at, of))),
            )

        return _let(grams, places)

    def long_runs(a: Column, size: int) -> Column:
        enough = F.filter(from_to(F.size(a) - size), lambda s: sum((F.get(a, s + m)["n"] for m in range(size)), F.lit(0)) >= long_words)
        return F.transform(enough, lambda s: place(F.xxhash64(*[F.get(a, s + m)["a"] for m in range(size)]), s, size, F.array(extended(a, s, 0, size))))

    def all_places(a: Column) -> Column:
        return F.concat(chosen(a), *([] if long_words is None else [long_runs(a, n) for n in range(1, span)]))

    keyed = docs.select(row_order(doc_id).alias("ord"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.col(text).alias(text))
    return keyed.select("ord", "th", F.explode(_let(hashed, all_places)).alias("p")).select("ord", "th", "p.*")


def _earliest(places: DataFrame, key: list[str], at: str) -> DataFrame:
    """``places`` whose key is found at several places, with the ``first`` of these, as (ord, at).

    No shuffle brings all places of a key together: they are dealt by document,
    and what is joined back is one row per key and part.
    """
    dealt = places.withColumn("deal", F.pmod(F.xxhash64("ord"), F.lit(DEALS)).cast("byte"))
    here = F.struct("ord", at)
    part = dealt.groupBy(*key, "deal").agg(F.min(here).alias("low"), F.max(here).alias("high"))
    whole = part.groupBy(*key).agg(F.min("low").alias("first"), F.max("high").alias("last"), F.collect_set("deal").alias("deals")).where("first <> last")
    return dealt.join(whole.select(*key, "first", F.explode("deals").alias("deal")), [*key, "deal"]).drop("deal")


def matches(docs: DataFrame, gram: int = 2, window: int = 2, doc_id: str = "doc_id", text: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """(ord, th, s, size, of_ord, of_s): ``size`` lines from number ``s`` on, and the earliest place of the same lines.

    Lines are numbered among those with a word.
    """
    chosen = written(fingerprints(docs, gram, window, doc_id, text, long_words), "line-fingerprints")
    shared = _earliest(chosen, ["fp"], "at").select("ord", "th", "at", "size", F.explode("ways").alias("w"))
    extended = shared.select("ord", "th", (F.col("at") - F.col("w.before")).alias("s"), "size", "w.k1", "w.k2")
    joined = _earliest(written(extended, "line-extensions"), ["k1", "k2"], "s").where(F.struct("ord", "s") > F.col("first"))
    return joined.select("ord", "th", "s", "size", F.col("first.ord").alias("of_ord"), F.col("first.s").alias("of_s"))


def repeated_lines(docs: DataFrame, gram: int = 2, window: int = 2, doc_id: str = "doc_id", text: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """(ord, th, gone): numbers of the lines in later copies of repeated runs, for documents that have any."""
    later = matches(docs, gram, window, doc_id, text, long_words)
    return later.select("ord", "th", F.explode(F.sequence("s", F.col("s") + F.col("size") - 1)).alias("line")).groupBy("ord", "th").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, gram: int = 2, window: int = 2, doc_id: str = "doc_id", text: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with ``text`` cut, and the columns ``n_lines`` and ``n_removed``.

    A line with a word goes if it lies in a run of ``gram + window - 1`` or more
    consecutive lines with a word, or of ``long_words`` or more words on however
    few lines (None: only the lines count), that also begins earlier: in a
    smaller doc_id (null is last), or earlier in the same document.  Lines are
    compared as they are, on the input, not on what is left.  Lines without a
    word stay and don't interrupt a run.  n_lines counts lines with a word.  Null texts stay
    null, with 0 lines.  Rows with equal doc_id count as one document, so a
    repeated row isn't an earlier copy of itself.  Columns of the two new names
    are replaced.
    """
    gone = repeated_lines(docs, gram, window, doc_id, text, long_words).withColumnsRenamed({"ord": "of_ord", "th": "of_th"})
    rows, at = hidden(docs), docs.columns.index(text)
    body = F.coalesce(F.col(f"c{at}"), F.lit(""))
    rows = rows.withColumns({"ord": row_order(f"c{docs.columns.index(doc_id)}"), "th": F.xxhash64(body)})
    joined = rows.join(gone, (F.col("ord") == F.col("of_ord")) & (F.col("th") == F.col("of_th")), "left")
    places = _let(_full_lines(body), lambda full: F.transform(F.col("gone"), lambda i: F.get(full, i)["no"]))
    cut = _let(
        F.split(body, "\n", -1),
        lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), places), lambda no: F.get(ls, no)), "\n"),
    )
    n_lines = F.size(F.filter(F.split(body, "\n", -1), lambda x: x.rlike(HAS_WORD)))
    new = {"n_lines": n_lines.cast("long"), "n_removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    left = joined.withColumns(new).withColumn(f"c{at}", F.when(F.col("gone").isNull(), F.col(f"c{at}")).otherwise(cut))
    return shown(left, docs.columns, *new)


def op10_sql(span: int = 3, long_words: int = LONG_WORDS) -> str:
    """DuckDB SQL of op10's rows."""

    def runs(size: int) -> str:
        over = lambda c: [c, *[f"lead({c}, {j}) OVER d" for j in range(1, size)]]
        text, words = " || chr(10) || ".join(over("line")), " + ".join(over("n_words"))
        return f"SELECT doc_id, s, {size} AS size, {text} AS run, {words} AS run_words FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY s)"

    return f"""
    WITH l AS (
      SELECT doc_id, i AS no, ls[i + 1] AS line
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), unnest(range(len(ls))) AS t(i)
    ), f AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS s, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n_words
      FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
    ), w AS (
      {" UNION ALL ".join(runs(n) for n in range(1, span + 1))}
    ), later AS (
      SELECT doc_id, s, size, row_number() OVER (PARTITION BY size, run ORDER BY doc_id, s) AS n
      FROM w WHERE run IS NOT NULL AND (size = {span} OR run_words >= {long_words})
    ), gone AS (
      SELECT DISTINCT doc_id, s + j AS s FROM later, unnest(range(size)) AS t(j) WHERE n > 1
    ), marked AS (
      SELECT l.doc_id, l.no, l.line, f.s IS NOT NULL AS is_full, g.s IS NOT NULL AS is_gone
      FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.no = l.no LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.s = f.s
    )
    SELECT doc_id, count(*) FILTER (WHERE is_full) AS n_lines, count(*) FILTER (WHERE is_gone) AS n_removed,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT is_gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
