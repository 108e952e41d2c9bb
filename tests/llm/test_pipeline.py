import gzip
import hashlib
import io
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_rows, frame, jaccard_classes, random_texts, words
from wickworks.llm import lines, mixing, warc

# --- mixing -----------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        per = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if per * w[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else per * w[s] for s in names}
        capped |= over


def mix_docs(spark, n=900):
    rng = random.Random(1)
    names = ["a", "b", "c", "é", "", None, "zz"]
    return frame(spark, [(i, "w " * rng.choice([0, 1, 5, 40, 300]), "en", names[rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])] if i > 3 else "tiny") for i in range(n)])


def test_targets_and_totals(spark):
    docs = mix_docs(spark)
    rows = mixing.mix(docs).collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    want = brute_targets(sizes)
    assert want.keys() == target.keys() and all(abs(want[s] - target[s]) < 1e-6 * (1 + want[s]) for s in want)
    assert all(abs(taken[s] - want[s]) <= 300 for s in want)  # within one document
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = mix_docs(spark)
    key = lambda df: sorted((r["doc_id"], r["copies"]) for r in mixing.mix(df).collect())
    assert key(docs) == key(docs.repartition(7).orderBy(F.desc("doc_id")))


def test_seeds_choose_others_at_the_same_rate(spark):
    """Whole copies are certain, the rest is drawn anew by each seed, and each source's words stay."""
    docs = frame(spark, [(i, "w " * (1 + i % 7), "en", "ab"[i % 2]) for i in range(60)])
    drawn, seeds = {}, 6
    for seed in range(seeds):
        words = {}
        for r in mixing.mix(docs, weights=(1, 3), seed=seed).collect():
            rate = r["target"] / r["source_size"]
            assert r["copies"] in (int(rate), int(rate) + 1)
            words[r["source_size"], r["target"]] = words.get((r["source_size"], r["target"]), 0) + r["taken"]
            drawn.setdefault(r["doc_id"], []).append(r["copies"] > int(rate))
        assert all(abs(taken - target) <= 7 for (_, target), taken in words.items())
    share = sum(map(sum, drawn.values())) / seeds / len(drawn)
    assert 0.35 < share < 0.65  # rates are 1/2 and 3/2 as the sources are alike
    assert sum(0 < sum(d) < seeds for d in drawn.values()) > len(drawn) / 2


def test_mix_of_edge_rows(spark):
    rows = edge_rows()
    docs = frame(spark, rows).withColumnRenamed("n_chars", "copies").withColumnRenamed("lang", "m")
    got = mixing.mix(docs).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"]) == sorted((r[0], len(words(r[1]))) for r in rows if r[0])
    mixed = mixing.mixed(docs)
    assert mixed.columns == [*docs.columns, "copy_no"]
    assert mixed.count() == sum(r["copies"] for r in got if r["size"])
    assert mixing.mix(docs.limit(0)).count() == mixing.mixed(docs.limit(0)).count() == 0
    nothing = frame(spark, [None, "", " "])
    assert [r["taken"] for r in mixing.mix(nothing).collect()] == [0, 0, 0] and mixing.mixed(nothing).count() == 0


# --- line dedup ---------------------------------------------------------------------


def brute_lines(docs, span=3):
    """[(n_lines, n_removed, text)] for (doc_id, text) rows, null ids last."""
    order = [(d is None, d or 0) for d, _ in docs]
    split = [(t or "").split("\n") for _, t in docs]
    full = [[i for i, x in enumerate(ls) if words(x)] for ls in split]
    first = {}
    for o, ls, at in zip(order, split, full):
        for s in range(len(at) - span + 1):
            key = tuple(ls[i] for i in at[s : s + span])
            first[key] = min(first.get(key, (o, s)), (o, s))
    out = []
    for (_, text), o, ls, at in zip(docs, order, split, full):
        gone = set()
        for s in range(len(at) - span + 1):
            if first[tuple(ls[i] for i in at[s : s + span])] < (o, s):
                gone.update(at[s : s + span])
        out.append((len(at), len(gone), None if text is None else "\n".join(x for i, x in enumerate(ls) if i not in gone)))
    return out


@pytest.mark.parametrize("gram,window", [(2, 2), (1, 1), (2, 4), (3, 1)])
def test_lines_match_brute_force(spark, gram, window):
    rng = random.Random(gram * 10 + window)
    texts = ["\n".join(rng.choice(["a", "b", "c", "", " ", "d e", f"own {rng.randrange(9)}"]) for _ in range(rng.randrange(1, 25))) for _ in range(60)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(r[0] and r[0] + 100, *r[1:]) for r in edge_rows()]
    got = lines.dedup_lines(frame(spark, rows), gram, window).collect()
    want = brute_lines([r[:2] for r in rows], gram + window - 1)
    assert sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in got), key=str) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=str)


def test_places_join_the_earliest_that_agrees_around_them(spark):
    """A shared fingerprint isn't enough: the places are extended to 3 lines, and the earliest equal run is found among them."""
    texts = ["x\np\nq\ny", "z\np\nq\nw", "z\np\nq\nw", "k\n\nz\np\nq\nw\nl"]
    got = {(r["ord"], r["s"], r["size"], r["of_ord"], r["of_s"]) for r in lines.matches(frame(spark, texts)).collect()}
    assert got == {(2, 0, 3, 1, 0), (2, 1, 3, 1, 1), (3, 1, 3, 1, 0), (3, 2, 3, 1, 1)}
    places = lines.fingerprints(frame(spark, texts), 2, 2).groupBy("ord", "at").count()
    assert places.where("count > 1").count() == 0


def test_hot_fingerprints_are_dealt_out(spark):
    """A run that all documents have: every place finds the earliest, and the plan joins by key and deal."""
    docs = frame(spark, ["same\nthree\nlines\n" + f"own {i}" for i in range(400)])
    assert lines.dedup_lines(docs).where("n_removed = 3").count() == 399
    shared = lines._earliest(lines.fingerprints(docs, 2, 2), ["fp"], "at")
    assert shared.count() == 400 and shared.select("first.ord").distinct().count() == 1
    keys = shared._jdf.queryExecution().optimizedPlan().toString()
    assert "deal" in keys


def test_line_columns_and_nothing(spark):
    docs = frame(spark, ["a\nb\nc", "a\nb\nc"]).withColumnRenamed("n_chars", "n_lines").withColumnRenamed("source", "ord")
    cut = lines.dedup_lines(docs)
    assert cut.columns == ["doc_id", "text", "lang", "ord", "n_lines", "n_removed"] and cut.where("n_removed = 3").count() == 1
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def brute_long_lines(docs, span, long_words):
    """[(doc_id, n_lines, n_removed, text)]: runs of ``span`` lines, or of fewer lines and ``long_words`` words, that begin earlier go."""
    first, runs, out = {}, [], []
    for i, (d, text) in enumerate(docs):
        ls = text.split("\n")
        at = [j for j, x in enumerate(ls) if words(x)]
        for size in range(1, span + 1):
            for s in range(len(at) - size + 1):
                run = [ls[j] for j in at[s : s + size]]
                if size == span or sum(len(words(x)) for x in run) >= long_words:
                    runs.append((i, d, s, at[s : s + size], tuple(run)))
                    first[tuple(run)] = min(first.get(tuple(run), (d, s)), (d, s))
    gone = [set() for _ in docs]
    for i, d, s, at, run in runs:
        if first[run] < (d, s):
            gone[i].update(at)
    for (d, text), g in zip(docs, gone):
        ls = text.split("\n")
        out.append((d, sum(bool(words(x)) for x in ls), len(g), "\n".join(x for j, x in enumerate(ls) if j not in g)))
    return out


def test_long_lines_go_however_few(spark):
    """The pipeline's stage removes later copies of one or two lines of 50 words together; shorter ones stay."""
    import corpus_pipeline

    passage = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    texts = [
        passage("a", 50) + "\nshort", passage("b", 30) + "\n\n" + passage("c", 20), passage("d", 49) + "\nend",
        "own\n" + passage("a", 50) + "\nshort\nrest", "own too\n" + passage("b", 30) + "\n" + passage("c", 20) + "\nrest too", passage("d", 49) + "\nafter\nshort",
    ]
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.STAGES[1][1](spark, frame(spark, texts), "").collect()}
    assert kept == {0: texts[0], 1: texts[1], 2: texts[2], 3: "own\nrest", 4: "own too\nrest too", 5: texts[5]}


@pytest.mark.parametrize("gram,window,long_words", [(2, 2, 5), (1, 1, 3), (2, 3, 6)])
def test_long_runs_match_brute_force(spark, gram, window, long_words):
    rng = random.Random(gram + window)
    line = lambda: rng.choice(["a", "b c", "", " ", "d e f", "g h i j k", "l m n o p q r", f"own {rng.randrange(99)}"])
    docs = [(i, "\n".join(line() for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    got = lines.dedup_lines(frame(spark, [(*d, "en", "s") for d in docs]), gram, window, long_words=long_words).collect()
    want = brute_long_lines(docs, gram + window - 1, long_words)
    assert sorted((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in got) == want
    assert gram + window < 3 or sum(w[2] for w in want) > sum(b[1] for b in brute_lines(docs, gram + window - 1))


# --- WARC -----------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def page_rows():
    rng = random.Random(3)
    body = "".join(rng.choice("abc <p>é\r\n") for _ in range(400))
    rows = [(i, f"http://h{i % 5}.Example.com/p/{i % 11}?q={i}#f", body[: 20 * (i % 9)] + ("" if i % 3 else str(i))) for i in range(120)]
    rows += [(500, None, None), (501, "", ""), (None, "https://x.org", body), (502, "HTTPS://user@x.org:80/a\r\nb", body), (502, "HTTPS://user@x.org:80/a\r\nb", body), (503, "x.org/a\tb", "\r\n\r\n" * 50), (504, "u", "z" * 3_000_000)]
    return rows


def brute_pages(rows):
    import hashlib

    payloads = [(r[2] or "").encode() for r in rows]
    first = {}
    for r, p in zip(rows, payloads):
        if r[0] is not None and len(p) >= 100:
            first[p] = min(first.get(p, r[0]), r[0])
    again = [r[0] is not None and len(p) >= 100 and r[0] > first[p] for r, p in zip(rows, payloads)]
    return sorted([(r[0], len(p), hashlib.sha256(p).hexdigest(), "revisit" if a else "response", first[p] if a else None) for r, p, a in zip(rows, payloads, again)], key=str)


def test_pages_come_back_through_the_index(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    folder, shards = warc.archive_pages(pages, file_bytes=3000, block_lines=7)
    got = warc.read_pages(pages, folder, shards).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == brute_pages(rows)
    for r in got:
        if r["record_type"] == "response" and r["page_id"] not in (None, 502):
            assert bytes(r["payload"]).decode() == (next(x[2] for x in rows if x[0] == r["page_id"]) or "")
    # some pages, one of them unknown
    few = spark.createDataFrame([(5, rows[5][1]), (77, rows[77][1]), (9999, "http://nowhere.org/")], "page_id long, url string")
    assert sorted(r["page_id"] for r in warc.read_pages(few, folder, shards).collect()) == [5, 77]


def test_revisits_are_held_against_their_responses(spark):
    body, other = "same text " * 30, "other text" * 30
    url = "http://a.example.com/\x85x\ty"  # its header is not its key

    def read(rows, asked):
        pages = spark.createDataFrame(rows, PAGES)
        made = warc.with_revisits(pages).where("ord <> 7")  # page 7's record is lost
        folder = warc.qualified(spark, warc.scratch_path(spark, "warc-test"))
        shards = warc.write_index(warc.write_archive(made, f"{folder}/archive"), f"{folder}/index")
        return warc.read_pages(spark.createDataFrame(asked, "page_id long, url string"), folder, shards, payloads=False).collect()

    rows = [(1, url, body), (2, "b.org", body), (3, None, body), (3, None, other), (9, "c.org", other)]
    # revisits alone: their responses are read though they weren't asked for
    got = {(r["page_id"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in read(rows, [(2, "b.org"), (9, "c.org")])}
    assert got == {(2, 1, 300, hashlib.sha256(body.encode()).hexdigest(), None), (9, 3, 300, hashlib.sha256(other.encode()).hexdigest(), None)}
    with pytest.raises(ValueError, match="page 8: response 7 is missing"):
        read([*rows, (7, "d.org", "x" * 200), (8, "e.org", "x" * 200)], [(1, url), (8, "e.org")])


def test_damaged_records_raise(spark):
    page = spark.createDataFrame([(1, "u", "text " * 40)], PAGES)
    folder = warc.qualified(spark, warc.scratch_path(spark, "warc-test"))
    made = warc.with_revisits(page).withColumn("digest", F.lit("0" * 64))
    shards = warc.write_index(warc.write_archive(made, f"{folder}/archive"), f"{folder}/index")
    with pytest.raises(ValueError, match="page 1: damaged"):
        warc.read_pages(page, folder, shards)


def test_archive_is_plain_warc(spark):
    pages = spark.createDataFrame(page_rows()[:20], PAGES)
    folder, _ = warc.archive_pages(pages)
    records = 0
    for path in pathlib.Path(folder.removeprefix("file://"), "archive").glob("*.warc.gz"):
        data = io.BytesIO(gzip.decompress(path.read_bytes()))
        while line := data.readline():
            assert line == b"WARC/1.1\r\n"
            fields = dict(x.decode().rstrip("\r\n").split(": ", 1) for x in iter(data.readline, b"\r\n"))
            data.read(int(fields["Content-Length"]))
            assert data.read(4) == b"\r\n\r\n"
            records += fields["WARC-Type"] != "warcinfo"
    assert records == 20


def test_index_is_written_once(spark):
    pages = spark.createDataFrame(page_rows(), PAGES)
    folder = warc.qualified(spark, warc.scratch_path(spark, "warc-test"))
    captures = warc.write_archive(warc.with_revisits(pages), f"{folder}/archive")
    at = pathlib.Path(folder.removeprefix("file://"))
    before = set(at.parent.iterdir())
    shards = warc.write_index(captures, f"{folder}/index", block_lines=7)
    assert set(at.parent.iterdir()) == before  # no table of a file a shard beside it
    assert len(shards) > 1 and sorted(s[2] for s in shards) == sorted(x.name for x in (at / "index").iterdir())
    lookup = warc.lookup(captures.select("key", "ord"), f"{folder}/index", shards)
    assert sorted(lookup.collect()) == sorted(captures.select(lookup.columns).collect())


def test_url_keys(spark):
    urls = ["http://a.Example.com/x?y#z", "https://u:p@b.c:8080/", "example.org", "//h.i/j", None, "", "ftp://x"]
    got = [r["k"] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u")).alias("k")).collect()]
    assert got == ["com,example,a)/x?y", "c:8080,b)/", "org,example)", "i,h)/j", ")", ")", "x)"]


def test_no_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    folder, shards = warc.archive_pages(empty)
    assert warc.read_pages(empty, folder, shards).count() == 0


# --- the pipeline -------------------------------------------------------------------------


def test_stages_against_brute_force(spark):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    texts = random_texts(8, 40, 3000, 150)
    texts = ["\n".join(" ".join(t.split()[i : i + 12]) for i in range(0, len(t.split()), 12)) for t in texts]
    item = "the benchmark asks which of these eleven words comes last here"
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)] + [(90, texts[0].replace("w", "v", 1), "en", "s0"), (91, f"clean start {item} and end", "en", "s1"), (92, "12 34", "en", "s1"), (93, None, "en", "s2")]
    path = warc.scratch_path(spark, "pipeline-test")
    frame(spark, rows).withColumn("extra", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    (_, lang), (_, cut), (_, near), (_, clean), (_, mix) = corpus_pipeline.STAGES

    kept = lang(spark, docs, path)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [r[0] for r in rows if r[0] not in (92, 93)]

    kept = cut(spark, kept, path)
    rows = [r for r in rows if r[0] in ids]
    want = {r[0]: w for r, w in zip(rows, brute_lines([r[:2] for r in rows]))}
    got = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == docs.columns and {i: r["text"] for i, r in got.items()} == {i: w[2] for i, w in want.items() if w[0] > w[1]}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    order = sorted(got)
    classes = jaccard_classes([got[i]["text"] for i in order])
    kept = near(spark, kept, path)
    stay = sorted({order[c] for c, _ in classes})
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == stay

    kept = clean(spark, kept, path)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [i for i in stay if i != 91]

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept).collect()}
    final = corpus_pipeline.run(spark, path).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in final} == {i: n for i, n in copies.items() if n}
