"""Top-k search and whitening against plain versions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clutchforge.llm import topk_search, whitening
from clutchforge.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, v string, w string, x string, number long, n long, `a.b` string, rank string"


def vectors(spark, rows, path):
    """embeddings with more columns of clashing names, read from files as jobs do."""
    full = [(i, v, 0, "v", "w", "x", 1, 2, "d", "r") for i, v in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def hard_vectors(seed=5, n=300, dims=7):
    r = random.Random(seed)
    rows = [(i, [float(np.float32(r.gauss(0, 0.3) + (0.2 if i % 3 else -0.1) * k)) for k in range(dims)]) for i in range(n)]
    rows += [(400 + i, list(rows[7][1])) for i in range(30)]  # ties
    rows += [(450, None), (500, [0.1, None, 0.2]), (550, [float("nan")] * dims), (600, [float("inf")] + [0.0] * (dims - 1)),
             (650, []), (700, [0.5, 0.25]), (None, list(rows[8][1])), (750, list(rows[9][1])), (750, list(rows[9][1])),
             (801, [0.0] * dims), (-50, [-1.0] * dims)]
    return rows


def fit_rows(rows):
    return [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


# ---- top-k search ----

def brute_topk(rows, k, scale=256):
    rows = [(i, [math.floor(scale * c) for c in v]) for i, v in fit_rows(rows)]
    out = []
    for i, q in rows:
        if i is None or i % 50:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, x)), j is None, j or 0) for j, x in rows if j != i)
        out += [(i, rank, None if unnamed else j, -s) for rank, (s, unnamed, j) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_rows": 64, "bits": 3}, {"block_rows": 50, "bits": 1, "part_bytes": 300, "k": 9},
                                     {"k": 1000}, {"scale": 1 << 20, "bits": 4}])
def test_topk_by_brute_force(llm, tmp_path, options):
    rows = hard_vectors()
    got = topk_search.search_topk(vectors(llm, rows, tmp_path / "t"), F.col("vec_id") % 50 == 0, **options).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_topk(rows, options.get("k", 5), options.get("scale", 256))


def test_topk_of_huge_components(llm, tmp_path):
    rows = [(0, [1e30, 1.0]), (1, [3e35, 0.0]), (2, [-1e30, 2.0]), (50, [1e9, -1e9]), (3, [1e9, 1e9]), (4, [0.5, 0.25])]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in
           topk_search.search_topk(vectors(llm, rows, tmp_path / "t"), F.col("vec_id") % 50 == 0, k=9).collect()}
    most = (1 << 63) - 1
    assert got[0, 1] == (1, most) and got[0, 5] == (2, -most)  # ends of a long
    big = 256 * 10 ** 9
    assert got[50, 5] == (2, max(-most, -(1 << 62) * big - 512 * big))
    assert got[50, 4] == (3, 0) and got[50, 3] == (4, 128 * big - 64 * big)


def test_topk_without_rows_or_queries(llm, tmp_path):
    some = vectors(llm, hard_vectors(), tmp_path / "t")
    for df in (some.limit(0), some.filter("vec_id = 450"), some.filter("vec_id % 50 <> 0"), some.filter("vec_id = 50")):
        assert topk_search.search_topk(df, F.col("vec_id") % 50 == 0).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_bitmap_sums(data):
    dims, n, bits = data.draw(st.integers(1, 5)), data.draw(st.integers(1, 130)), data.draw(st.integers(1, 6))
    r = np.random.default_rng(data.draw(st.integers(0, 10 ** 6)))
    x = r.integers(-300, 300, (n, dims))
    q = r.integers(-1000, 1000, dims)
    row = topk_search.build_block(np.arange(n), np.ones(n, bool), x, bits)
    block = topk_search.Block(type("Row", (), row), dims, bits)
    query = topk_search.Query(q)
    assert ((query.digits * (1 << np.arange(query.digits.shape[1]))).sum(axis=1) == q).all() if q.any() else True
    slices, offset = topk_search.weighted_sum(block.slices, query.digits, bits)
    u = (x - x.min(axis=0)) >> block.shift
    sums = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:n].astype(int) << w for w, s in enumerate(slices))
    sums = sums if isinstance(sums, np.ndarray) else np.zeros(n, dtype=int)
    assert (sums + offset == u @ q).all()
    everyone = np.packbits((np.arange(block.slices.shape[1] * 64) < n).astype(np.uint8), bitorder="little").view("<u8")
    k = data.draw(st.integers(1, n))
    kth = sorted(sums)[-k]
    assert topk_search.kth_largest(slices, everyone, k) == kth
    for value in (kth, kth + 1, 0, -5, 10 ** 9):
        assert topk_search.positions(topk_search.at_least(slices, everyone, int(value)), n).tolist() == np.flatnonzero(sums >= value).tolist()


# ---- whitening ----

def reference_model(rows, scale=1024, offset=100000):
    dims = max(len(v) for _, v in rows)
    x = [[math.floor(scale * c) + offset for c in v] + [offset] * (dims - len(v)) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    apart = [[n * e - s for e, s in zip(row, sums)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in apart), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, columns = np.linalg.eigh(v)
    return x, n, apart, v, values[::-1], columns[:, ::-1]


def check_whitened(df, rows, most=8):
    rows = fit_rows(rows)
    _, n, apart, v, values, columns = reference_model(rows)
    size = min(most, int((values > values[0] * 1e-12).sum()))
    got = whitening.whitened_components(df).collect()
    assert len(got) == size * len(rows) and {r.n for r in got} == {n}
    centred = np.array(apart, dtype=float) / n
    want = {}
    for (i, _), row, a in zip(rows, centred, apart):
        for k in range(size):
            want.setdefault((i, k + 1), []).append((row @ columns[:, k] / math.sqrt(values[k]), sum(e * e for e in a)))
    signs = {}
    for r in got:
        values_here = [w for w, _ in want[r.vec_id, r.component]]
        assert r.deviation in [d for _, d in want[r.vec_id, r.component]]
        w = min(values_here, key=lambda w: abs(abs(w) - abs(r.whitened)))
        assert abs(abs(w) - abs(r.whitened)) < 1e-7
        if abs(w) > 1e-3:
            signs.setdefault(r.component, set()).add((w > 0) == (r.whitened > 0))
        assert abs(r.explained - values[r.component - 1] / v.trace()) < 1e-10
        assert 0 <= r.identity_error < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_by_eigh(llm, tmp_path):
    rows = hard_vectors(dims=11)
    check_whitened(vectors(llm, rows, tmp_path / "t"), rows)


def test_whitening_of_the_small_table(llm):
    df = table(llm, SF_SMALL, "embeddings")
    check_whitened(df, [(r.vec_id, list(r.embedding)) for r in df.collect()])


def test_whitening_of_low_rank(llm, tmp_path):
    rows = [(i, [float(i % 7), 3.0 * (i % 7), 0.5, float(i % 2)]) for i in range(40)]
    check_whitened(vectors(llm, rows, tmp_path / "t"), rows)


def test_whitening_without_variance(llm, tmp_path):
    same = vectors(llm, [(i, [0.5, 0.25]) for i in range(9)], tmp_path / "t")
    for df in (same, same.limit(1), same.limit(0), vectors(llm, [(1, None), (2, [None]), (3, [])], tmp_path / "u")):
        assert whitening.whitened_components(df).count() == 0


def test_exact_parts_beyond_doubles():
    r = random.Random(2)
    x = np.array([[r.randrange(-(1 << 40), 1 << 40) for _ in range(3)] for _ in range(50)])
    assert whitening.exact_sums(x * (1 << 21)) == [sum(int(e) << 21 for e in c) for c in x.T]
    assert whitening.exact_products(x).tolist() == [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in x.T] for p in x.T]
    model = whitening.Model(50, [int(s) for s in x.sum(axis=0)], np.ones(1), np.ones((3, 1)), 1.0)
    _, deviations = whitening.project(x, model)
    exact = [sum((50 * int(e) - s) ** 2 for e, s in zip(row, model.sums)) for row in x]
    assert deviations == [d if d < 1 << 63 else None for d in exact]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10 ** 6), st.integers(0, 12))
def test_cholesky_and_jacobi(n, seed, rank):
    r = np.random.default_rng(seed)
    a = r.normal(size=(n, min(rank, n))) * 10.0 ** r.integers(-3, 4)
    v = a @ a.T
    low = whitening.pivoted_cholesky(v)
    assert np.allclose(low @ low.T, v, atol=1e-9 * max(1e-300, np.abs(v).max(initial=0)))
    values, columns = whitening.components_of(v, n)
    assert np.allclose(columns.T @ columns, np.eye(len(values)), atol=1e-9)
    assert np.allclose((columns * values) @ columns.T, v, atol=1e-9 * max(1e-300, np.abs(v).max(initial=0)))
