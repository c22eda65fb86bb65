"""Exact top-k search by inner product over a bit-sliced index.

Index: vectors become integers ``x = floor(scale * component)``. Rows are dealt to
blocks; in a block each attribute (component) is quantised to ``BITS`` bits above
its minimum, ``x = low + 2**shift * u + rest``, and bit b of all u of an attribute
is one slice, a bitmap over the block's rows. The block keeps the integers too.

Search: with the query's components written in signed binary digits, the weighted
sum of the attributes is a sum of shifted slices (complements where the digit is
-1). Carry-save adders over whole bitmaps add them up, so the sum comes out as
slices again. From its most significant slice downward the k-th largest sum is
found by counting bits. The dropped rests bound the error of a sum, so only rows
whose sum comes within that bound of the k-th can be among the k best; these
boundary rows are resolved with exact integer products.

Spark: the index is a table of blocks, written once. Queries are searched in parts
of at most ``PART_BYTES``, which are broadcast one after the other; a task scans
its blocks, keeps k rows per query and hands on only those, and the final choice
is a window over at most k rows per query and task.

Defined results: queries and candidates are rows with a vector that is not null
and has only finite components (times ``scale`` finite too); a shorter vector counts
as having zeros at its end, an empty one as zeros. A candidate is every row whose id
is not the query's. Ties go to smaller ids, null ids come last and are no queries;
repeated rows are candidates each, and a repeated query is answered once per row.
Integers beyond +-2**62 and scores beyond +-(2**63 - 1) end there. Without queries there
are no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, prepare, scratch, table
from .vectors import FAR, LONG_MAX, finite_vectors, longest, matrix, scaled_floor
from .workers import tidy

SCALE = 256
BITS = 7            # slices of an attribute
BLOCK_BYTES = 16 << 20  # of the integers of a block
PART_BYTES = 4 << 20  # of queries that are broadcast at once
WIDE = 1 << 40      # blocks or queries with larger integers are resolved without slices

INDEX = "n int, ids binary, named binary, x binary, low binary, shift int, slices binary"


# ---- index ----

def build_block(ids: np.ndarray, named: np.ndarray, x: np.ndarray, bits: int) -> dict:
    """An index row of the rows ``x`` (integers, one row each)."""
    n, dims = x.shape
    low = x.min(axis=0) if n else np.zeros(dims, dtype=np.int64)
    shift, slices = 0, np.zeros((0, 0), dtype=np.uint64)
    if np.abs(x).max(initial=0) < WIDE:
        above = x - low
        shift = max(0, int(above.max(initial=0)).bit_length() - bits)
        u = (above >> shift).T
        padded = np.zeros((dims, bits, -(-n // 64) * 64), dtype=np.uint8)
        padded[:, :, :n] = (u[:, None, :] >> np.arange(bits)[None, :, None]) & 1
        slices = np.packbits(padded, axis=2, bitorder="little").view("<u8")
    return {"n": n, "ids": ids.astype("<i8").tobytes(), "named": named.astype(np.uint8).tobytes(), "x": x.astype("<i8").tobytes(),
            "low": low.astype("<i8").tobytes(), "shift": shift, "slices": slices.tobytes()}


def _block_builder(dims: int, scale: int, bits: int, block_rows: int):
    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def blocks(least: int) -> Iterator[pa.RecordBatch]:
            while held and sum(len(h[0]) for h in held) >= least:
                ids, named, x = (np.concatenate(c) for c in zip(*held))
                held[:] = [(ids[block_rows:], named[block_rows:], x[block_rows:])] if len(ids) > block_rows else []
                row = build_block(ids[:block_rows], named[:block_rows], x[:block_rows], bits)
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema(
                    [("n", pa.int32()), *[(c, pa.binary()) for c in ("ids", "named", "x", "low")], ("shift", pa.int32()), ("slices", pa.binary())]))

        for batch in batches:
            ids = batch.column("vec_id")
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            held.append((ids, named, scaled_floor(matrix(batch.column("v"), dims), scale)))
            yield from blocks(block_rows)
        yield from blocks(1)
    return build


class Block:
    """One index row in memory."""

    def __init__(self, row, dims: int, bits: int):
        self.n, self.shift = row.n, row.shift
        self.ids, self.named = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.named, np.uint8).astype(bool)
        self.x = np.frombuffer(row.x, "<i8").reshape(self.n, dims)
        self.low = np.frombuffer(row.low, "<i8")
        self.slices = np.frombuffer(row.slices, "<u8").reshape(dims * bits, -(-self.n // 64)) if row.slices else None
        self.most = max(abs(int(self.x.max(initial=0))), abs(int(self.x.min(initial=0))))


# ---- bitmap arithmetic ----

def signed_digits(values: np.ndarray) -> np.ndarray:
    """Digits -1, 0, 1 of integers (one row each, lowest first), no two neighbours of them nonzero."""
    digits, left = [], values.astype(np.int64)
    while left.any():
        odd = (left & 1) == 1
        digit = np.where(odd, 2 - (left & 3), 0)
        digits.append(digit.astype(np.int8))
        left = (left - digit) >> 1
    return np.array(digits, dtype=np.int8).reshape(len(digits), len(values)).T


def add_bitmaps(columns: dict[int, list[np.ndarray]], width: int) -> list[np.ndarray]:
    """The slices, lowest first, of the sum over all bitmaps of 2**weight * bitmap;
    ``columns`` holds stacks of bitmaps by weight."""
    out = []
    weight = 0
    while columns:
        stack = columns.pop(weight, [])
        weight += 1
        rows = np.concatenate(stack) if stack else np.zeros((0, width), dtype=np.uint64)
        carries = []
        while len(rows) > 2:  # full adders: three bitmaps to one and a carry
            m = len(rows) // 3
            a, b, c = rows[:m], rows[m:2 * m], rows[2 * m:3 * m]
            half = a ^ b
            carries.append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[3 * m:]])
        if len(rows) == 2:
            carries.append(rows[:1] & rows[1:])
            rows = rows[:1] ^ rows[1:]
        if carries:
            columns.setdefault(weight, []).extend(carries)
        out.append(rows[0] if len(rows) else np.zeros(width, dtype=np.uint64))
    return out


def weighted_sum(slices: np.ndarray, digits: np.ndarray, bits: int) -> tuple[list[np.ndarray], int]:
    """Slices of sum(q_j * u_j) over attributes j, and a number to add to them."""
    columns: dict[int, list[np.ndarray]] = {}
    offset = 0
    for place in range(digits.shape[1]):
        plus, minus = np.flatnonzero(digits[:, place] == 1), np.flatnonzero(digits[:, place] == -1)
        for b in range(bits):
            stack = columns.setdefault(place + b, [])
            if len(plus):
                stack.append(slices[plus * bits + b])
            if len(minus):  # -bit = complement - 1
                stack.append(~slices[minus * bits + b])
                offset -= len(minus) << (place + b)
    return add_bitmaps(columns, slices.shape[1]), offset


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_largest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among ``rows`` (a bitmap of at least k), from the top slice downward."""
    value = 0
    for weight in range(len(slices) - 1, -1, -1):
        ones = rows & slices[weight]
        n = count(ones)
        if n >= k:
            rows, value = ones, value | (1 << weight)
        else:
            k -= n
            rows = rows & ~slices[weight]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """The bitmap of those ``rows`` whose sum is ``value`` or more."""
    if value <= 0:
        return rows
    if value.bit_length() > len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for weight in range(len(slices) - 1, -1, -1):
        if value >> weight & 1:
            equal = equal & slices[weight]
        else:
            above |= equal & slices[weight]
            equal = equal & ~slices[weight]
    return above | equal


def positions(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=n, bitorder="little"))


# ---- search ----

class Query:
    """A query's integers with what the search needs of them."""

    def __init__(self, q: np.ndarray):
        self.q, self.plain = q, [int(v) for v in q]
        self.size = sum(map(abs, self.plain))
        self.gain = sum(v for v in self.plain if v > 0)
        self.narrow = max(map(abs, self.plain), default=0) < WIDE
        self.digits = signed_digits(q) if self.narrow else None


def exact_scores(block: Block, query: Query, rows: np.ndarray) -> np.ndarray:
    if block.most * query.size < FAR:
        return block.x[rows] @ query.q
    products = block.x[rows].astype(object) @ np.array(query.plain, dtype=object)
    return np.array([max(-LONG_MAX, min(LONG_MAX, int(v))) for v in products], dtype=np.int64)


def boundary_rows(block: Block, query: Query, own: np.ndarray, k: int, bits: int, least: int | None) -> np.ndarray:
    """Rows of the block that can be among its k best, and above ``least`` (a score reached k times already)."""
    if block.slices is None or not query.narrow or block.most * query.size >= FAR:
        return np.setdiff1d(np.arange(block.n), own)
    rows = np.zeros(block.slices.shape[1] * 64, dtype=np.uint8)
    rows[:block.n] = 1
    rows[own] = 0
    rows = np.packbits(rows, bitorder="little").view("<u8")
    slices, offset = weighted_sum(block.slices, query.digits, bits)
    unit = 1 << block.shift
    wanted = 0
    if block.n - len(own) > k:
        wanted = kth_largest(slices, rows, k) - (unit - 1) * query.size // unit
    if least is not None:
        base = sum(a * int(b) for a, b in zip(query.plain, block.low)) + (unit - 1) * query.gain + unit * offset
        wanted = max(wanted, -((base - least) // unit))
    return positions(at_least(slices, rows, wanted), block.n)


def _searcher(shared, dims: int, k: int, bits: int):
    """Tasks: the k best rows of the task's blocks for every query of the part."""

    @tidy
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = [(number, vec_id, Query(np.frombuffer(x, "<i8"))) for number, vec_id, x in shared.value]
        best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, id is null, id), ascending
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                block = Block(row, dims, bits)
                for slot, (_, vec_id, query) in enumerate(queries):
                    own = np.flatnonzero((block.ids == vec_id) & block.named)
                    held = best[slot]
                    rows = boundary_rows(block, query, own, k, bits, -held[-1][0] if len(held) == k else None)
                    if not len(rows):
                        continue
                    scores = exact_scores(block, query, rows)
                    if len(rows) > k:
                        cut = np.partition(scores, len(rows) - k)[len(rows) - k]
                        rows, scores = rows[scores >= cut], scores[scores >= cut]
                    order = np.lexsort((block.ids[rows], ~block.named[rows], -scores))[:k]
                    new = [(-int(scores[o]), not block.named[rows[o]], int(block.ids[rows[o]])) for o in order]
                    best[slot] = sorted(held + new)[:k]
        out = [(number, vec_id, None if unnamed else i, -less)
               for (number, vec_id, _), held in zip(queries, best) for less, unnamed, i in held]
        if out:
            cols = list(zip(*out))
            yield pd.DataFrame({"number": cols[0], "query_id": cols[1], "vec_id": pd.array(cols[2], dtype="Int64"), "score": cols[3]})
    return search


def _query_rows(dims: int):
    """Index rows to one row per vector: vec_id and its integers."""
    @tidy
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                block = Block(row, dims, 0)
                at = np.flatnonzero(block.named)
                for turn in range(0, len(at), 1000):
                    some = at[turn:turn + 1000]
                    yield pd.DataFrame({"vec_id": block.ids[some], "x": [block.x[i].tobytes() for i in some]})
    return rows


def build_index(vectors: DataFrame, dims: int, scale: int = SCALE, bits: int = BITS, block_rows: int | None = None) -> DataFrame:
    """The bit-sliced index of ``vectors`` (vec_id, v), written to the shared folder."""
    block_rows = block_rows or max(64, BLOCK_BYTES // (8 * max(1, dims)))
    return materialise(vectors.mapInArrow(_block_builder(dims, scale, bits, block_rows), INDEX), "sliced")


def search_topk(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: int = SCALE, bits: int = BITS, block_rows: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``df`` for every row whose ``vec_id`` meets ``is_query``."""
    spark = prepare(df.sparkSession)
    vectors = finite_vectors(df, id_col, vec_col)
    dims = longest(vectors)
    index = build_index(vectors, dims, scale, bits, block_rows)
    plain = index.select("n", "ids", "named", "x", "low", "shift", F.lit(None).cast("binary").alias("slices"))
    queries = materialise(plain.mapInPandas(_query_rows(dims), "vec_id long, x binary").filter(is_query), "queries")
    queries = queries.withColumn("number", F.monotonically_increasing_id())  # of the written rows: the same in every pass
    parts = max(1, -(-queries.count() * (8 * dims + 64) // part_bytes))
    paths = []
    for part in range(parts):
        some = queries.filter(F.pmod("number", F.lit(parts)) == part).select("number", "vec_id", "x").collect()
        shared = spark.sparkContext.broadcast([(r["number"], r["vec_id"], bytes(r["x"])) for r in some])
        found = index.mapInPandas(_searcher(shared, dims, k, bits), "number long, query_id long, vec_id long, score long")
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        paths.append(scratch(spark, "found"))
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
            .select("query_id", "rank", "vec_id", "score").write.parquet(paths[-1])
        shared.destroy()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(*paths)


def op12_topk_search(spark, sf_dir: str) -> DataFrame:
    return search_topk(table(prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def oracle() -> str:
    return """
with rows as (
  select vec_id, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::bigint as score
  from rows q join rows c on c.vec_id is distinct from q.vec_id where q.vec_id % 50 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 5"""
