"""Exact deduplication by composable polynomial fingerprints.

A text (whitespace runs normalised to one space, UTF-8) is hashed chunk by
chunk as ``sum((byte + 1) * B**i) mod (2**61 - 1)`` with numpy; chunks of one
document combine by length-shifted arithmetic, ``h(a + b) = h(a) + B**len(a) *
h(b)``, so the chunks of a huge document are hashed in parallel tasks. Rows
with equal (fingerprint, length) are candidates; their texts are then compared
chunk by chunk: within a group, a chunk number is equal everywhere iff its
smallest and largest bytes are the same, which Spark's aggregate decides with
map-side combining, so a group of copies of any size collapses before the
shuffle. Groups that fail (fingerprint collisions) are regrouped by their texts.

Defined results: null text counts as empty; of equal texts the row with the
smallest doc_id stays (null ids last); among repeated rows of that id exactly
one stays; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, materialise, prepare, table, text_rows

MODULUS = (1 << 61) - 1
BASE = 0x1B873593CC9E2D51 % MODULUS
CHUNK_BYTES = 1 << 16


class Polynomial:
    """Fingerprints of byte chunks and their composition, modulo ``modulus`` (at most 61 bits)."""

    def __init__(self, modulus: int = MODULUS, base: int = BASE, longest: int = CHUNK_BYTES):
        self.p, self.b, self.longest = modulus, base % modulus, longest
        self._low = self._high = None

    def _tables(self, n: int) -> None:
        """The powers of the base, split into 31 low and 30 high bits."""
        if self._low is not None and len(self._low) >= n:
            return
        powers, x = [], 1
        for _ in range(n):
            powers.append(x)
            x = x * self.b % self.p
        powers = np.array(powers, dtype=np.uint64)
        self._low, self._high = powers & np.uint64((1 << 31) - 1), powers >> np.uint64(31)

    def chunks(self, chunks: list[bytes]) -> list[int]:
        lens = np.array([len(c) for c in chunks], dtype=np.int64)
        out = [0] * len(chunks)
        full = np.flatnonzero(lens)
        if not len(full):
            return out
        self._tables(int(lens.max()))
        data = np.frombuffer(b"".join(chunks), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum(lens[full])
        starts = ends - lens[full]
        at = np.arange(len(data)) - np.repeat(starts, lens[full])
        low = np.add.reduceat(data * self._low[at], starts)
        high = np.add.reduceat(data * self._high[at], starts)
        for i, a, b in zip(full.tolist(), low.tolist(), high.tolist()):
            out[i] = (a + (b << 31)) % self.p
        return out

    def combine(self, parts: list[tuple[int, int]]) -> int:
        """The fingerprint of a text from (fingerprint, length) of its chunks in order."""
        h, shift = 0, 1
        for part, n in parts:
            h = (h + shift * part) % self.p
            shift = shift * pow(self.b, n, self.p) % self.p
        return h


def _hash_chunks(modulus: int, base: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        poly = Polynomial(modulus, base)
        for pdf in batches:
            out = pdf.drop(columns="chunk")
            out["part"] = np.array(poly.chunks(list(pdf["chunk"])), dtype=np.int64)
            yield out
    return run


def _normalised(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.regexp_replace(F.coalesce("text", F.lit("")), WHITESPACE, " "))


def _with_chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk: columns of ``rows`` but text, ``no`` and ``chunk`` (an empty text has one).
    A text is encoded once and cut once, and its chunks leave without it."""
    others = [c for c in rows.columns if c != "text"]
    coded = rows.select(*others, F.encode("text", "UTF-8").alias("coded"))
    last = f"cast((greatest(octet_length(coded), 1) - 1) div {chunk_bytes} as int)"
    cut = F.expr(f"transform(sequence(0, {last}), i -> substring(coded, i * {chunk_bytes} + 1, {chunk_bytes}))")
    return coded.select(*others, F.posexplode(cut).alias("no", "chunk"))


def fingerprints(docs: DataFrame, modulus: int = MODULUS, base: int = BASE,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its fingerprint, length, SHA-256 and locator."""
    poly = Polynomial(modulus, base)
    keys = "uid long, doc_id long, n_bytes long, locator long, text_sha256 string"
    raw_long = F.coalesce(F.octet_length("text"), F.lit(0)) > chunk_bytes
    rows = docs.withColumn("uid", F.monotonically_increasing_id())
    about = ["uid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
             F.xxhash64("text").alias("locator"), F.sha2("text", 256).alias("text_sha256")]
    short = _normalised(rows.filter(~raw_long)).select(*about, F.encode("text", "UTF-8").alias("chunk"))
    short = short.mapInPandas(_hash_chunks(modulus, base), f"{keys}, part long").withColumnRenamed("part", "fp")
    # Long texts: their chunks go to different tasks and are combined in order.
    long = _normalised(rows.filter(raw_long)).select(*about, "text")
    long = _with_chunks(long, chunk_bytes).withColumn("chunk_len", F.octet_length("chunk"))
    long = long.repartition("uid", "no").mapInPandas(_hash_chunks(modulus, base),
                                                     f"{keys}, no int, chunk_len int, part long")

    @F.pandas_udf("long")
    def combined(parts: pd.Series) -> pd.Series:
        return pd.Series([poly.combine([(x["part"], x["chunk_len"]) for x in sorted(p, key=lambda x: x["no"])])
                          for p in parts], dtype="int64")

    names = ["uid", "doc_id", "n_bytes", "locator", "text_sha256"]
    long = long.groupBy(*names).agg(F.collect_list(F.struct("no", "part", "chunk_len")).alias("parts"))
    return short.unionByName(long.select(*names, combined("parts").alias("fp")))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = MODULUS,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = text_rows(docs, id_col, text_col)
    prints = materialise(fingerprints(docs, modulus, chunk_bytes=chunk_bytes), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("first")
    size = F.count(F.lit(1)).alias("group_size")
    groups = materialise(prints.groupBy("fp", "n_bytes").agg(first, size).filter("group_size > 1"), "groups")

    # Candidates' texts, compared chunk by chunk within their group.
    members = prints.join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"], "left_semi") \
        .select("doc_id", "locator", "fp", "n_bytes").distinct()
    texts = _normalised(docs).withColumn("locator", F.xxhash64("text"))
    texts = texts.alias("t").join(members.alias("m"), F.expr("t.doc_id <=> m.doc_id and t.locator = m.locator")) \
        .select("m.fp", "m.n_bytes", "m.doc_id", "m.locator", "t.text")
    differ = _with_chunks(texts.drop("doc_id", "locator"), chunk_bytes).groupBy("fp", "n_bytes", "no") \
        .agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).filter("lo <> hi")
    collided = materialise(differ.select("fp", "n_bytes").distinct(), "collided")

    out = prints.join(groups, ["fp", "n_bytes"], "left")
    if not collided.isEmpty():
        # Different texts with one fingerprint: those groups are regrouped by the texts themselves.
        rows = texts.join(collided, ["fp", "n_bytes"], "left_semi")
        ids = prints.join(collided, ["fp", "n_bytes"], "left_semi").select("uid", "doc_id", "locator")
        exact = ids.alias("i").join(
            rows.select("doc_id", "locator", "text").distinct().alias("r"),
            F.expr("i.doc_id <=> r.doc_id and i.locator = r.locator")).select("i.uid", "i.doc_id", "r.text")
        again = exact.groupBy("text").agg(first, size).select("text", "first", "group_size")
        fixed = exact.join(again, "text").select("uid", F.col("first").alias("first2"), F.col("group_size").alias("size2"))
        out = out.join(fixed, "uid", "left").withColumn("first", F.coalesce("first2", "first")) \
            .withColumn("group_size", F.coalesce("size2", "group_size"))
    single = F.col("first").isNull()
    return out.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("uid") == F.col("first.uid"))).alias("kept"), "text_sha256")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_exact(table(prepare(spark), sf_dir, "documents"))


def oracle() -> str:
    return r"""
with d as (select row_number() over () as rid, doc_id,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by t) as group_size,
       row_number() over w = 1 as kept, sha256(t) as text_sha256
from d window w as (partition by t order by doc_id nulls last, rid)"""
