"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source is to be taken a fractional number of times, the same
for all its documents.  The whole part is taken for certain.  The fractions are
rounded in pairs: of two documents' fractions, mass (counted in words) moves at
random from one to the other until one of them is 0 or 1, so that every
document keeps its expectation and the pair its sum.  What stays fractional of
a block of documents meets the rests of other blocks, in a tree of reductions,
until each source has one rest at most, which is rounded by itself.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickworks.llm.base import hidden, shown, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the rows by source in code point order from 0, null last.

    Range partitions are numbered inside; how many rows lie before each
    partition is a sum over the few partitions.
    """
    n = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = sources.withColumn("is_null", F.col("source").isNull()).repartitionByRange(n, "is_null", "source").withColumn("part", F.spark_partition_id())
    cut = written(cut, "mix-sources")
    sizes = cut.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("part").orderBy("is_null", "source"))
    return cut.withColumn("inner", inner).join(before, "part").withColumn("rank", F.col("before") + F.col("inner") - 1).drop("part", "inner", "before", "is_null")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with the column target.

    Sources in code point order, null last, weigh ``weights``, repeating, and
    share the sum of all sizes by weight; a target over ``most`` times its
    source's size stops there, and the excess is shared by weight among the
    others until none is above.
    """
    ranked = _ranked(sizes).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double"))
    ranked = written(ranked, "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    per_weight = 0.0
    while True:  # each round stops one source more at least; what is shared per unit of weight only grows
        stopped = F.col("w") * F.lit(per_weight) >= most * F.col("source_size")
        stopped_size, free = ranked.agg(F.sum(F.when(stopped, F.col("source_size"))), F.sum(F.when(~stopped, F.col("w")))).first()
        if not free:
            break
        now = (total - most * (stopped_size or 0)) / free
        if now <= per_weight:
            break
        per_weight = now
    target = F.least(F.col("w") * F.lit(per_weight), (most * F.col("source_size")).cast("double"))
    return ranked.withColumn("target", target).drop("rank", "w")


def _unit(*key: Column) -> Column:
    """A number in [0, 1) fixed by the key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


def _pivot(level: int, seed: int) -> Column:
    """Fold a block's array ``units`` of (id, s, f): the unit that stays fractional, and the decided ones."""
    nobody = F.struct(F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("s"), F.lit(0.0).alias("f"))
    start = F.struct(nobody.alias("c"), F.expr("array()").cast("array<struct<id:bigint,s:bigint,up:boolean>>").alias("out"))

    def with_f(unit: Column, f: Column) -> Column:
        return F.struct(unit["id"].alias("id"), unit["s"].alias("s"), F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0)).alias("f"))

    def decided(unit: Column, up: Column) -> Column:
        return F.struct(unit["id"].alias("id"), unit["s"].alias("s"), up.alias("up"))

    def step(state: Column, x: Column) -> Column:
        c, out = state["c"], state["out"]
        # words that may move from x to c (give) and from c to x (take) before one is 0 or 1
        give = F.least((1 - c["f"]) * c["s"], x["f"] * x["s"])
        take = F.least(c["f"] * c["s"], (1 - x["f"]) * x["s"])
        to_c = _unit(F.lit(seed), F.lit(level), c["id"], c["s"], x["id"], x["s"]) * (give + take) < take
        c_ends = F.when(to_c, (1 - c["f"]) * c["s"] <= x["f"] * x["s"]).otherwise(c["f"] * c["s"] <= (1 - x["f"]) * x["s"])
        moved = F.when(to_c, give).otherwise(-take)
        # who ends is decided: c full or x empty if mass went to c, else c empty or x full
        stays = F.when(c_ends, with_f(x, x["f"] - moved / x["s"])).otherwise(with_f(c, c["f"] + moved / c["s"]))
        done = F.when(c_ends, decided(c, to_c)).otherwise(decided(x, ~to_c))
        paired = F.struct(stays.alias("c"), F.concat(out, F.array(done)).alias("out"))
        return F.when(c["s"] == 0, F.struct(with_f(x, x["f"]).alias("c"), out.alias("out"))).otherwise(paired)

    return F.aggregate(F.col("units"), start, step)


def rounded(units: DataFrame, most: int, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """(source, id, s, up) for ``units`` of (source, n, id, s, f): each fraction f rounded to 0 or 1.

    Per source the sum of f * s is kept to within one unit's s.  (id, s) is
    unique in its source; f lies strictly between 0 and 1, s is positive; n is
    about the number of the source's units and ``most`` the largest n.

    About two blocks of each source stay out of the tree.  They meet its rest at
    last, the large before the small, so that what remains is small as a rule;
    it goes to the nearer of 0 and 1.
    """
    share = F.ceil(F.col("n") / F.lit(2.0 * block)).cast("long")
    is_late = F.pmod(F.xxhash64(F.lit(seed), F.lit(-2), "id", "s"), share) == 0
    late, left = units.where(is_late), units.where(~is_late)
    decided, level = [], 0
    while most > 1:
        blocks = F.ceil(F.col("n") / F.lit(float(block))).cast("long")
        dealt = left.withColumn("n", blocks).withColumn("at", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "id", "s"), F.col("n")))
        folded = _folded(dealt, ["source", "n", "at"], level, seed)
        decided.append(folded)
        left = folded.select("source", "n", "r.c.*").where("s > 0")
        most, level = -(-most // block), level + 1
    last = _folded(left.unionByName(late), ["source"], -1, seed)
    out = last.where("r.c.s > 0").select("source", "r.c.id", "r.c.s", (F.col("r.c.f") >= 0.5).alias("up"))
    for d in [*decided, last]:
        out = out.unionByName(d.select("source", F.explode("r.out").alias("d")).select("source", "d.*"))
    return out


def _folded(units: DataFrame, by: list[str], level: int, seed: int) -> DataFrame:
    """The units of each group folded in order of size, the largest first, and written."""
    order = F.struct((-F.col("s")).alias("o"), F.xxhash64(F.lit(seed), "id", "s").alias("h"), "id", "s", "f")
    lists = units.groupBy(*by).agg(F.array_sort(F.collect_list(order)).alias("units"))
    return written(lists.select(*[c for c in by if c != "at"], _pivot(level, seed).alias("r")), "mix-level")


def planned(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int) -> DataFrame:
    """Units (doc_id, source, size, m) of ``docs`` (doc_id, source, size), m rows each, with source_size, target and all: copies of the m rows together."""
    units = written(docs.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
    targets = written(source_targets(sizes, weights, most), "mix-targets")
    largest = targets.agg(F.max("n")).first()[0] or 0
    rate = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    of = units.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    of = of.withColumn("want", rate * F.col("m")).withColumn("whole", F.floor("want")).withColumn("f", F.col("want") - F.col("whole"))
    up = rounded(of.where("f > 0").select("source", "n", F.col("doc_id").alias("id"), F.col("size").alias("s"), "f"), largest, seed)
    up = up.where("up").select(F.col("source").alias("of"), "id", "s", "up")
    same = F.col("source").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("size") == F.col("s"))
    copies = (F.col("whole") + F.when(F.col("up"), 1).otherwise(0)).cast("long")
    return of.join(up, same, "left").select("doc_id", "source", "size", "m", "source_size", "target", copies.alias("all"))


def _dealt(row: str) -> Column:
    """Copies of the ``row``-th (from 0) of a unit's m rows."""
    return (F.floor(F.col("all") / F.col("m")) + F.when(F.col(row) < F.col("all") % F.col("m"), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 1, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """How many times each document is taken.

    Returns doc_id, source, size (words), source_size, target (its source's
    words to take, see ``source_targets``), copies, taken (copies * size), a row
    per input row.  Reruns with the same ``seed`` agree.  A null or empty text
    has size 0 and is taken 0 times; a source without words has target 0.  Rows
    alike in doc_id, source and size are one unit whose copies are dealt to them
    evenly.  No document is taken more than ``most`` times.
    """
    sized = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    rows = planned(sized, weights, most, seed).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    return rows.withColumn("copies", _dealt("i")).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 1) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, with ``copy_no`` from 1 (a column of that name is replaced)."""
    id_, source, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "source", "text"))
    rows = hidden(docs).withColumns({"doc_id": id_.cast("long"), "source": source, "size": word_count(text)})
    plan = planned(rows.select("doc_id", "source", "size"), weights, most, seed).where("all > 0")
    # keys without nulls: the numbering and the join then need one shuffle
    named = F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source"))
    key = {"k1": F.coalesce("doc_id", F.lit(0)), "k2": F.concat(F.col("doc_id").isNull().cast("string"), named), "k3": F.col("size")}
    plan = plan.withColumns(key).select(*key, "m", "all")
    rows = rows.withColumns(key).withColumn("i", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(text))) - 1)
    taken = rows.join(plan, list(key)).withColumn("copies", _dealt("i")).where("copies > 0")
    return shown(taken.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs.columns, "copy_no")
