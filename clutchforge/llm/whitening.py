"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi
on the triangular factor.

Components become integers x = floor(scale * c) + offset. Three passes over the rows:

1. n and the exact sums S of every dimension (tasks hand on one number per dimension).
2. The scatter: x is centred at the integer m nearest to S / n before anything is
   multiplied, tasks add up exact products of the centred rows, and what the integer
   centre is off the mean, d = S / n - m, is removed exactly:
   n * sum((x - S/n)(x - S/n)') = n * sum((x - m)(x - m)') - n^2 d d', all in integers.
   One rounding makes each entry of the covariance V a double.
3. Each row is centred as (n * x - S) / n and projected on the components.

Between 2 and 3 the model, whose size is the square of the dimension, is computed:
V = L L' with pivoting, L's columns are rotated in disjoint pairs until they are
orthogonal; squared column norms are the eigenvalues, normalised columns the
components. Their sign makes the largest entry positive.

The covariance of the whitened rows is then taken over all rows (mean first, then
centred products) and compared with the identity.

Defined results: rows whose vector is null or holds null or non-finite entries are
dropped; a shorter vector counts as having zeros at its end; null ids and repeated
rows are kept as they are; x saturates at about 2**62; a deviation that no long can
hold is null. Directions without variance (eigenvalue below 1e-12 of the largest) can't be
whitened and have no component, so constant vectors, a single row and an empty
table give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .vectors import LONG_MAX, finite_vectors, longest, matrix, scaled_floor
from .workers import tidy

SCALE = 1024
OFFSET = 100000
COMPONENTS = 8
RANK = 1e-12      # of the largest eigenvalue: smaller ones count as none
SWEEPS = 60       # at most; a dozen is usual

EXACT_DOUBLE = 1 << 53
EXACT = "decimal(38,0)"


def integers(lists: pa.Array, dims: int, scale: int, offset: int) -> np.ndarray:
    return scaled_floor(matrix(lists, dims), scale) + offset


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of integers."""
    if int(np.abs(x).max(initial=0)) * len(x) < LONG_MAX:
        return [int(s) for s in x.sum(axis=0)]
    return [sum(column) for column in x.T.tolist()]


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y of integers: by doubles where they are exact, else by Python integers (as an object array)."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < EXACT_DOUBLE:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64)
    o = y.astype(object)
    return o.T @ o


def _as_decimals(values: list[int]) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def _sum_rows(dims: int, scale: int, offset: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in batches:
            x = integers(batch.column("v"), dims, scale, offset)
            n += len(x)
            sums = [a + b for a, b in zip(sums, exact_sums(x))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), _as_decimals(sums)],
                                             ["i", "n", "s"])
    return run


def _scatter_rows(dims: int, scale: int, offset: int, centre: list[int]):
    upper = np.triu_indices(dims)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]), dtype=object)
        seen = False
        for batch in batches:
            x = integers(batch.column("v"), dims, scale, offset)
            if len(x):
                seen = True
                total = total + exact_products(x - np.array(centre, dtype=np.int64))[upper].astype(object)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()),
                                              _as_decimals([int(v) for v in total])], ["i", "j", "s"])
    return run


# ---- the model ----

def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with v = L L' (rows in v's order; lower triangular in the order of the pivots), one column per rank."""
    rest = v.astype(float).copy()
    n = len(rest)
    order = np.arange(n)
    out = np.zeros((n, n))
    first = rest.diagonal().max(initial=0.0)
    for k in range(n):
        p = k + int(np.argmax(rest.diagonal()[order[k:]]))
        order[[k, p]] = order[[p, k]]
        pivot = rest[order[k], order[k]]
        if pivot <= first * np.finfo(float).eps * n:
            return out[:, :k]
        below = order[k:]
        out[below, k] = rest[below, order[k]] / math.sqrt(pivot)
        rest[np.ix_(below, below)] -= np.outer(out[below, k], out[below, k])
    return out


def one_sided_jacobi(columns: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """The columns rotated until they are orthogonal. In every step disjoint pairs
    are rotated together; a sweep of steps (round robin) meets all pairs."""
    a = columns.copy()
    n = a.shape[1]
    if n < 2:
        return a
    players = np.arange(n + n % 2)  # an odd one out sits still
    limit = np.finfo(float).eps * math.sqrt(len(a))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(players) - 1):
            p, q = players[:len(players) // 2], players[:len(players) // 2 - 1:-1]
            both = (p < n) & (q < n)
            p, q = p[both], q[both]
            alpha, beta = (a[:, p] ** 2).sum(axis=0), (a[:, q] ** 2).sum(axis=0)
            gamma = (a[:, p] * a[:, q]).sum(axis=0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > limit * size
            worst = max(worst, float((np.abs(gamma[turn]) / size[turn]).max(initial=0.0)))
            p, q, alpha, beta, gamma = p[turn], q[turn], alpha[turn], beta[turn], gamma[turn]
            zeta = (beta - alpha) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            left, right = a[:, p], a[:, q]
            a[:, p], a[:, q] = c * left - c * t * right, c * t * left + c * right
            players = np.concatenate([players[:1], players[-1:], players[1:-1]])
        if worst <= limit:
            break
    return a


@dataclass
class Model:
    """n rows with sums S; eigenvalues fall, ``components`` are columns."""
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns), the ``most`` largest with variance."""
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    values = (turned ** 2).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > RANK * values.max(initial=0.0)][:most]
    vectors = turned[:, order] / np.sqrt(values[order])
    largest = np.abs(vectors).argmax(axis=0) if vectors.size else np.zeros(0, dtype=int)
    return values[order], vectors * np.where(vectors[largest, np.arange(len(order))] < 0, -1.0, 1.0)


def fit(vectors: DataFrame, dims: int, scale: int = SCALE, offset: int = OFFSET, most: int = COMPONENTS) -> Model:
    """The model of ``vectors`` (vec_id, v). What comes back from the tasks is one number per
    dimension, then one per pair of dimensions."""
    rows = vectors.select("v")
    sums = rows.mapInArrow(_sum_rows(dims, scale, offset), f"i int, n long, s {EXACT}").groupBy("i") \
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    if not sums:
        return Model(0, [0] * dims, np.zeros(0), np.zeros((dims, 0)), 0.0)
    n = sums[0]["n"]
    total = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    centre = [(2 * s + n) // (2 * n) for s in total]
    off = [s - n * m for s, m in zip(total, centre)]  # n * d
    products = rows.mapInArrow(_scatter_rows(dims, scale, offset, centre), f"i int, j int, s {EXACT}").groupBy("i", "j") \
        .agg(F.sum("s").alias("s")).collect()
    v = np.zeros((dims, dims))
    for r in products:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["s"]) - off[i] * off[j]) / (n * n)  # integers, divided with one rounding
    values, columns = components_of(v, most)
    return Model(n, total, values, columns, math.fsum(v.diagonal()))


# ---- applying it ----

def project(x: np.ndarray, model: Model) -> tuple[np.ndarray, list[int | None]]:
    """Whitened rows and their exact deviations, sum((n * x - S)**2)."""
    n, sums = model.n, model.sums
    ends = np.concatenate([x.min(axis=0), x.max(axis=0)]).tolist() if len(x) else []
    reach = max((abs(n * end - s) for end, s in zip(ends, sums + sums)), default=0)
    if reach * reach * max(1, len(sums)) < LONG_MAX and n * max(map(abs, ends), default=0) < LONG_MAX:
        apart = n * x - np.array(sums, dtype=np.int64)
        deviations = (apart * apart).sum(axis=1).tolist()
    else:
        apart = n * x.astype(object) - np.array(sums, dtype=object)
        deviations = [d if d <= LONG_MAX else None for d in (apart * apart).sum(axis=1)]
    centred = (apart / n).astype(float)
    return centred @ model.components / np.sqrt(model.eigenvalues), deviations


def _whitener(model: Model, dims: int, scale: int, offset: int):
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("w", pa.list_(pa.float64()))])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, deviations = project(integers(batch.column("v"), dims, scale, offset), model)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviations, pa.int64()), pa.array(w.tolist(), schema.field("w").type)],
                                             schema=schema)
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET,
           most: int = COMPONENTS) -> tuple[DataFrame, Model]:
    """(vec_id, deviation, w: the whitened components) of every row with a finite vector, written
    to the shared folder, and the model."""
    prepare(df.sparkSession)
    vectors = finite_vectors(df, id_col, vec_col)
    dims = longest(vectors)
    model = fit(vectors, dims, scale, offset, most)
    if not len(model.eigenvalues):
        vectors = vectors.limit(0)
    return materialise(vectors.mapInArrow(_whitener(model, dims, scale, offset), "vec_id long, deviation long, w array<double>"), "whitened"), model


def identity_error(whitened: DataFrame, size: int) -> float:
    """The largest entry of the whitened rows' covariance less the identity: two aggregates over all rows."""
    if not size:
        return 0.0
    means = whitened.agg(*[F.avg(F.col("w")[i]) for i in range(size)]).first()
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    covariance = whitened.agg(*[F.avg((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(covariance, pairs))


def whitened_components(df: DataFrame, **options) -> DataFrame:
    """One row per row and component."""
    rows, model = whiten(df, **options)
    size = len(model.eigenvalues)
    shares = F.array(*[F.lit(float(e) / model.trace) for e in model.eigenvalues]) if size else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(identity_error(rows, size)).alias("identity_error"))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened_components(table(prepare(spark), sf_dir, "embeddings"))
