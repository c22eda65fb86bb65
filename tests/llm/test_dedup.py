"""Exact dedup and the n-gram Jaccard join against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest

from clutchforge.llm import bitmaps, exact_dedup, jaccard_join
from clutchforge.llm.components import connected_components

from .conftest import frame, hard_rows

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_fingerprints_compose():
    p = exact_dedup.Polynomial(longest=16)
    text = "Länge ist nicht alles, aber viel.".encode()
    whole = p.chunks([text])[0]
    for cut in (0, 1, 7, len(text)):
        a, b = p.chunks([text[:cut], text[cut:]])
        assert p.combine([(a, cut), (b, len(text) - cut)]) == whole
    assert p.chunks([text])[0] != p.chunks([text + b"\0"])[0]
    direct = sum((x + 1) * pow(p.b, i, p.p) for i, x in enumerate(text)) % p.p
    assert whole == direct


@pytest.mark.parametrize("modulus", [exact_dedup.MODULUS, 3])  # 3: nearly all texts of a length collide
def test_exact_dedup_by_brute_force(llm, modulus):
    rows = hard_rows() + [(300, "x\ty", "s"), (299, "x y", "s"), (301, "y x", "s"), (302, "z y", "s"), (303, "z  y", "s")]
    got = exact_dedup.dedup_exact(frame(llm, rows), modulus=modulus, chunk_bytes=1000).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        want += [(i if i is not None else -1, first if first is not None else -1, len(ids),
                  hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.text_sha256)
                  for r in got) == sorted(want)
    assert sum(r.kept for r in got) == len(groups)  # one row of each, repeated rows included
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_of_huge_texts(llm):
    import time
    from pyspark.sql import functions as F
    half = llm.range(3).select(F.col("id").alias("doc_id"), F.expr("repeat('seven c', 7150000)").alias("text"))  # 50 MB each
    path = exact_dedup.materialise(half.withColumn("text", F.when(F.col("doc_id") == 2, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), "huge")
    began = time.time()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_exact(path).collect()}
    assert got == {0: (0, 2, True), 1: (0, 2, False), 2: (2, 1, True)}
    assert time.time() - began < 120  # encoding a text again for each of its chunks took hours


def test_exact_dedup_empty(llm):
    assert exact_dedup.dedup_exact(frame(llm, hard_rows()).limit(0)).count() == 0


def components_by_brute_force(rows, n, percent):
    sets = []
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _, _) in enumerate(rows):
        r = find(i)
        if doc is not None and (least[r] is None or doc < least[r]):
            least[r] = doc
    return sorted((-1 if d is None else d, len(sets[i]), -1 if least[find(i)] is None else least[find(i)])
                  for i, (d, _, _) in enumerate(rows)), sum(find(i) == i for i in range(len(rows)))


def near_copies(seed, groups, size):
    import random
    r = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]
    common = [r.choice(words) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [r.choice(words) for _ in range(r.randint(40, 150))] + common  # a passage that all share
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((len(rows), " ".join(w), "s"))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, percent, block, frequent", [(3, 90, 1 << 20, 64), (5, 80, 1500, 8)])
def test_jaccard_components_by_brute_force(llm, monkeypatch, n, percent, block, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = near_copies(1, 8, 14) + [(1000 + i if i is not None else None, t, s) for i, t, s in hard_rows()]
    got = jaccard_join.jaccard_join(frame(llm, rows), n, percent).collect()
    want, components = components_by_brute_force(rows, n, percent)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in got) == want
    assert sum(r.first for r in got) == components


@pytest.mark.parametrize("n, percent, block, work, frequent", [(3, 90, 1 << 20, 1 << 29, 64), (5, 80, 1500, 1 << 29, 8), (5, 80, 1 << 20, 20_000, 8)])
def test_links_by_brute_force(llm, monkeypatch, n, percent, block, work, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "WORK", work)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = near_copies(1, 8, 14) + [(1000 + i if i is not None else None, t, s) for i, t, s in hard_rows()]
    rows += [(2000 + k, rows[k][1], "s") for k in range(0, 60, 3)]  # copies inside groups of near copies
    got = jaccard_join.jaccard_join(frame(llm, rows), n, percent, links=True).collect()
    words = [(t or "").split() for _, t, _ in rows]
    sets = [{tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for w in words]
    key = lambda d: -1 if d is None else d
    want = sorted((key(d), sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= percent * len(a | b)))
                  for i, ((d, _, _), a) in enumerate(zip(rows, sets)))
    assert sorted((key(r.doc_id), r.n_links) for r in got) == want
    components, _ = components_by_brute_force(rows, n, percent)
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == components
    assert max(x for _, x in want) > 13


def said(seed, k):
    import random
    r = random.Random(seed)
    return [f"{seed}x{r.randrange(1 << 30)}" for _ in range(k)]


def sharing(docs, passage, own):
    """Documents that have one passage in common and are far from linked."""
    shared = said("p", passage)
    return [(i, " ".join(said(f"d{i}", own) + shared), "s") for i in range(docs)]


@pytest.mark.parametrize("docs, passage, own, most", [(40, 130, 90, 1 << 20), (12, 30, 200, 0)])
def test_a_common_passage_makes_no_bucket(llm, monkeypatch, docs, passage, own, most):
    """Most of a document, hashed beyond the first shingles too; or, where the threshold has doubled, in longer lists."""
    monkeypatch.setattr(jaccard_join, "FREQUENT_MOST", most)
    rows = sharing(docs, passage, own)
    copies = [(1000 + i, t + " more", "s") for i, t, _ in rows[:3]]
    seen, count = [], jaccard_join._count
    monkeypatch.setattr(jaccard_join, "_count", lambda texts, buckets, *more: seen.append(buckets) or count(texts, buckets, *more))
    got = jaccard_join.jaccard_join(frame(llm, rows + copies), links=True).collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in got) == sorted(
        (i, i % 1000, int(i % 1000 < 3)) for i, _, _ in rows + copies)
    assert seen[0].count() <= 12  # the three pairs, and not all documents


def test_links_where_texts_are_joined_by_sorting(llm, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(jaccard_join, "broadcast_counted", lambda df: df.hint("merge"))
    docs = frame(llm, [(i, " ".join(said(f"d{i // 2}", 60) + [str(i)]), "s") for i in range(40)] + sharing(300, 0, 40)[40:])
    moved, among = [], jaccard_join._among
    monkeypatch.setattr(jaccard_join, "_among", lambda *a: moved.append((among(*a), a[1])) or moved[-1][0])
    got = jaccard_join.jaccard_join(docs, links=True).collect()
    assert sorted(r.doc_id for r in got if r.n_links) == list(range(40)) and {r.n_links for r in got} == {0, 1}
    for rows, ids in moved:
        uids = {r.uid for r in rows.collect()}
        assert {r.uid for r in ids.collect()} <= uids and len(uids) < 120  # few of the others


def test_packed_sets():
    import numpy as np
    r = np.random.default_rng(4)
    new = lambda k: r.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)
    bases = [np.unique(new(400)) for _ in range(3)]
    near = [np.unique(np.concatenate([np.delete(bases[k % 3], r.integers(0, 399, k % 5)), new(k % 4)])) for k in range(90)]
    odd = [np.unique(r.integers(0, 600, 200).astype(np.uint64)) for _ in range(20)] + [new(1), np.zeros(0, dtype=np.uint64)]
    for sets in (near, odd, near + odd, near[:1]):
        assert all(np.array_equal(a, b) for a, b in zip(sets, jaccard_join.unpack(jaccard_join.pack(sets)), strict=True))
    assert len(jaccard_join.pack(near)) * 15 < sum(s.nbytes for s in near)


def test_bitmap(llm):
    import numpy as np
    from pyspark.sql import functions as F
    values = llm.range(3000).select(F.xxhash64("id").alias("v"))
    words = bitmaps.bitmap(values.union(values.limit(10)), 3000)
    member = np.array([x.v for x in values.collect()], dtype=np.int64).view(np.uint64)
    others = np.array([x.v for x in llm.range(5000, 15000).select(F.xxhash64("id").alias("v")).collect()], dtype=np.int64).view(np.uint64)
    assert bitmaps.holds(words, member).all() and bitmaps.holds(words, others).mean() < 0.1
    assert not bitmaps.holds(bitmaps.bitmap(values.limit(0), 0), member).any()


def test_jaccard_empty_and_drop(llm):
    docs = frame(llm, near_copies(2, 3, 5))
    assert jaccard_join.jaccard_join(docs.limit(0)).count() == 0
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    names = {r.component_id for r in jaccard_join.jaccard_join(docs, 5, 80).collect()}
    assert {r.doc_id for r in kept.collect()} == names


def test_divide_skip_finds_all_partners():
    import numpy as np
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 200, 60).astype(np.uint64)) for _ in range(6)]
    sets = [np.unique(np.concatenate([b, rng.integers(0, 4000, k).astype(np.uint64)])) for b in base for k in range(8)]
    for percent in (50, 80, 90):
        bucket = jaccard_join.Bucket(sets, percent)
        ranked = [sets[i] for i in bucket.order]
        for q in range(len(ranked)):
            want = [c for c in range(q + 1, len(ranked)) if 100 * len(np.intersect1d(ranked[q], ranked[c]))
                    >= percent * len(np.union1d(ranked[q], ranked[c]))]
            assert bucket.partners(q) == want


def test_components(llm):
    edges = llm.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (102, 101), (200, 200)], "a long, b long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert connected_components(edges.limit(0)).count() == 0
