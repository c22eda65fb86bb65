"""Mixing sources to target weights by pivotal dependent rounding (DataFrame expressions only).

Targets: every source asks for its weight's part of the mix and stops at
``max_copies`` times its size; what exceeds is shared again by weight until no
source is above. Copies: each document of a source may be taken
``target / source size`` times; the whole part is certain, the fractional
parts are rounded together. Two documents meet, a random one of them receives
the other's probability mass (measured in words, so the words taken in
expectation stay put) until one of the two is certain; the other carries the
residual on. Documents meet in hashed blocks of about ``BLOCK``, the residuals
of the blocks meet in blocks again: a reduction tree of fan-in ``BLOCK`` whose
last residual per source goes to the nearer side. Within a block the largest
documents meet first, so the residual that is carried on is a small one. A source of any size is cut into as many
blocks as it needs.

Draws hash (seed, ids), so reruns agree on every layout. Identical (id, source,
size) rows are rounded as one item of their joint mass and share its copies.

Defined results: null text has size 0 (and takes 0 words); a null source is a
source of its own, last in order; null ids are ids; empty tables give no rows;
a mix larger than ``max_copies`` times everything takes every document that often.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, materialise, prepare, split_words, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
BLOCK = 128
SALTS = 64  # shares of a group of repeated rows
SEED = 20


def _numbered(sources: DataFrame) -> DataFrame:
    """``rank`` (from 0) in code point order, null last: range partitions with
    the counts of earlier partitions added, so no task sees all sources."""
    placed = materialise(
        sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), "source")
        .select("*", F.monotonically_increasing_id().alias("at")), "sources")
    part = F.shiftright("at", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).count()
                    .select("p", F.col("count").alias("n")).collect())  # one row per task
    before, rank = 0, F.lit(None).cast("long")
    for p, n in counts:
        rank = F.when(part == p, before + F.col("at").bitwiseAND((1 << 33) - 1)).otherwise(rank)
        before += n
    return placed.withColumn("rank", rank).drop("at")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row per source of ``sized`` (source, size)."""
    sources = materialise(_numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("rank") % len(weights) + 1).cast("int"))), "weights")
    cap = F.col("source_size") * max_copies
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # The price of a weight unit rises as sources fill up; each round fills at least one more, or ends.
    price, full = -1.0, F.lit(False)
    while True:
        r = sources.agg(F.sum(F.when(full, cap).otherwise(0)).alias("caps"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weights")).first()
        if not r["weights"]:
            break
        new = (share * total - r["caps"]) / r["weights"]
        if new <= price:
            break
        price, full = new, cap <= F.col("weight") * new
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * price) if price >= 0 else cap.cast("double")
    return sources.select("source", "source_size", target.alias("target"))


def _draw(*ids: Column) -> Column:
    """A uniform number in [0, 1) made from the ids."""
    return F.pmod(F.xxhash64(*ids), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pivot(acc: Column, x: Column, level: int) -> Column:
    """The residual in ``acc`` meets ``x``; the one that gets certain goes to ``out``."""
    a, b = acc["left"], x
    up = F.least((1.0 - a["p"]) * a["size"], b["p"] * b["size"])  # words that may move to a
    down = F.least(a["p"] * a["size"], (1.0 - b["p"]) * b["size"])  # words that may move to b
    to_a = _draw(F.lit(SEED + level), a["key"], b["key"]) * (up + down) < down
    a_full = (1.0 - a["p"]) * a["size"] <= b["p"] * b["size"]  # moving to a makes a certain
    a_empty = a["p"] * a["size"] <= (1.0 - b["p"]) * b["size"]  # moving to b makes a certain not

    def sure(r: Column, copies: int) -> Column:
        return F.array(F.struct(r["key"].alias("key"), F.lit(copies).alias("extra")))

    def left(r: Column, p: Column) -> Column:
        return F.struct(r["size"].alias("size"), r["key"].alias("key"),
                        F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"))

    def step(done: Column, rest: Column) -> Column:
        return F.struct(rest.alias("left"), F.concat(acc["out"], done).alias("out"))

    pivoted = F.when(to_a & a_full, step(sure(a, 1), left(b, b["p"] - up / b["size"]))) \
        .when(to_a, step(sure(b, 0), left(a, a["p"] + up / a["size"]))) \
        .when(a_empty, step(sure(a, 0), left(b, b["p"] + down / b["size"]))) \
        .otherwise(step(sure(b, 1), left(a, a["p"] - down / a["size"])))
    return F.when(a.isNull(), F.struct(b.alias("left"), acc["out"].alias("out"))).otherwise(pivoted)


_ITEM = "struct<size:double,key:bigint,p:double>"
_OUT = "array<struct<key:bigint,extra:int>>"


def round_pivotal(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, extra in 0/1) for ``items`` (source, key, size > 0, p in (0, 1)); per
    source the words taken differ from their expectation by at most one item."""
    items = materialise(items.select("source", "key", F.col("size").cast("double").alias("size"), "p"), "level0")
    counts = materialise(items.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    decided, level = [], 0
    while most:
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1))
        packed = items.alias("i").join(counts.alias("c"), F.expr("i.source <=> c.source")) \
            .select("i.source", F.struct("i.size", "i.key", "i.p").alias("item"),
                    F.pmod(F.xxhash64(F.lit(SEED + level), F.col("i.key")), blocks.cast("long")).alias("block")) \
            .groupBy("source", "block").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
        start = F.struct(F.lit(None).cast(_ITEM).alias("left"), F.array().cast(_OUT).alias("out"))
        folded = materialise(packed.select("source", F.aggregate(
            "items", start, lambda acc, x: _pivot(acc, x, level)).alias("r")), f"level{level + 1}")
        decided.append(folded.select(F.explode("r.out").alias("o")).select("o.key", "o.extra"))
        rest = folded.filter("r.left is not null").select("source", "r.left.key", "r.left.size", "r.left.p")
        if most <= block:
            decided.append(rest.select("key", (F.col("p") >= 0.5).cast("int").alias("extra")))
            break
        items, level = rest, level + 1
        # One residual per non-empty block at most; the tree narrows by the fan-in.
        counts = counts.select("source", F.ceil(F.col("n") / block).alias("n"))
        most = math.ceil(most / block)
    out = decided[0] if decided else items.select("key", F.lit(0).alias("extra"))
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per distinct (source, doc_id, size) with its number of rows, source_size, target and
    the copies that its rows take together."""
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        _size(text_col).alias("size"))
    items = materialise(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows")), "items")
    plan = materialise(targets(items.select("source", (F.col("size") * F.col("rows")).alias("size")),
                               weights, share, max_copies), "targets")
    want = F.when(F.col("source_size") > 0, F.col("rows") * F.col("target") / F.col("source_size")).otherwise(0.0)
    items = items.alias("i").join(plan.alias("t"), F.expr("i.source <=> t.source")) \
        .select("i.*", "t.source_size", "t.target") \
        .withColumn("key", F.xxhash64(F.lit(SEED), "source", "doc_id", "size")).withColumn("want", want) \
        .withColumn("whole", F.least(F.floor("want"), F.col("rows") * max_copies)) \
        .withColumn("p", F.when(F.col("size") > 0, F.greatest(F.col("want") - F.col("whole"), F.lit(0.0))).otherwise(0.0))
    open_ = items.filter((F.col("p") > 0) & (F.col("p") < 1)).select("source", "key", "size", "p")
    return items.join(round_pivotal(open_), "key", "left").select(
        "source", "doc_id", "size", "rows", "source_size", "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long").alias("copies"))


def _size(text_col: str) -> Column:
    return F.size(split_words(F.col(text_col).cast("string"), WHITESPACE)).cast("long")


def _each(row: Column) -> Column:
    """The copies of row number ``row`` (from 1) of an item: as even as can be."""
    more = (row <= F.col("copies") % F.col("rows")).cast("long")
    return (F.floor(F.col("copies") / F.col("rows")) + more).cast("long")


def mix_sources(docs: DataFrame, **how) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken."""
    row = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row")
    return decide(docs, **how).select("*", row).withColumn("copies", _each(F.col("row"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns), every row as often as the mix takes it."""
    own = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    names = [n for n in (f"_mix{i}" for i in range(len(docs.columns) + 6)) if n not in docs.columns][:6]
    size, copies, row = names[:3]
    plan = materialise(decide(docs), "plan")
    rows = docs.withColumn(size, _size("text")).alias("d").join(
        plan.alias("p"), F.expr(f"d.source <=> p.source and d.doc_id <=> p.doc_id and d.{size} = p.size")) \
        .select("d.*", F.col("p.rows").alias(row), F.col("p.copies").alias(copies))
    taken = rows.filter(F.col(row) == 1).withColumn(row, F.col(copies))
    if not plan.filter("rows > 1").isEmpty():
        taken = taken.unionByName(_repeated(rows, names))
    return taken.filter(F.col(row) > 0) \
        .withColumn(size, F.explode(F.sequence(F.lit(1).cast("long"), F.col(row)))).select(*own)


def _repeated(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows that share source, id and size with others, each with its own number of copies. They are numbered inside
    ``SALTS`` shares of such a group, which may hold any part of all rows; counts per share place the shares."""
    size, copies, row, salt, place, number = names
    again = materialise(rows.filter(F.col(row) > 1).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))), "again")
    key = ["source", "doc_id", size]
    inside = F.row_number().over(Window.partitionBy(*key, salt).orderBy("text"))
    earlier = Window.partitionBy(*key).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    shares = again.groupBy(*key, salt).agg(F.count(F.lit(1)).alias("n")) \
        .select(*key, salt, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    same = F.expr(" and ".join(f"a.{c} <=> s.{c}" for c in [*key, salt]))
    numbered = again.withColumn(place, inside).alias("a").join(shares.alias("s"), same) \
        .select("a.*", (F.col(f"a.{place}") + F.col("s.base")).alias(number))
    more = (F.col(number) <= F.col(copies) % F.col(row)).cast("long")
    return numbered.withColumn(row, (F.floor(F.col(copies) / F.col(row)) + more).cast("long")).drop(place, number, salt)


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(prepare(spark), sf_dir, "documents")).drop("source", "copies")
