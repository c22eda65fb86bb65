"""Periodic runs against brute force."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clutchforge.llm import periodic_runs

from .conftest import frame, hard_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=6, exponent=4):
    """Every maximal stretch of every distance, those with a smaller period left out."""
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            size = j - i + p
            if j > i and size >= max(least, exponent * p) and not any(
                    all(w[k] == w[k + q] for k in range(i, i + size - q)) for q in range(1, p)):
                out.append((i, size, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


@st.composite
def sequences(draw):
    w = draw(st.lists(st.integers(0, draw(st.integers(0, 6))), max_size=40))
    for _ in range(draw(st.integers(0, 3))):
        if w:
            a, p = draw(st.integers(0, len(w) - 1)), draw(st.integers(1, 8))
            for i in range(a + p, min(len(w), a + draw(st.integers(1, 6)) * p)):
                w[i] = w[i - p]
    return w


@settings(max_examples=400, deadline=None)
@given(sequences(), st.sampled_from([(6, 4), (2, 2), (6, 2), (3, 3), (10, 5)]))
def test_runs_and_stretches(w, limits):
    want = brute_runs(w, *limits)
    assert periodic_runs.runs_of(w, *limits) == want  # the automaton on everything
    assert periodic_runs.text_runs([b"%d" % x for x in w], *limits) == want  # behind the choice of stretches


def test_long_stretches_in_arrays(monkeypatch):
    import random
    r = random.Random(2)
    texts = []
    for _ in range(60):
        w = [r.randrange(4) for _ in range(r.randint(0, 50))]
        for i in range(len(w) // 3 + 3, len(w)):
            w[i] = w[i - 3]
        texts.append(w)
    want = [periodic_runs.runs_of(w, 2, 2) for w in texts]
    monkeypatch.setattr(periodic_runs, "LONG", 0)
    assert [periodic_runs.runs_of(w, 2, 2) for w in texts] == want == [brute_runs(w, 2, 2) for w in texts]


def test_gram_keys_do_not_overflow():
    import numpy as np
    ids = np.array([0, 1 << 40, 5, 0, 1 << 40, 5, 7])
    keys = periodic_runs.gram_keys(ids, 3)
    assert keys[0] == keys[3] and len(set(keys.tolist())) == 4


def test_planted_texts(llm):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37)), "s") for i in range(200)] + [(None, "a b", "s"), (10 ** 15, "x \t y\n", "s")]
    got = periodic_runs.periodic_tails(frame(llm, rows)).collect()
    want = {i: planted(i, WORD.findall(t)) for i, t, _ in rows}
    assert {r.doc_id: WORD.findall(r.text) for r in got} == want


def test_query_by_brute_force(llm, tmp_path):
    loop = "da capo al fine " * 30
    rows = hard_rows() + [(200, loop, "s"), (201, "ja " * 6 + "nein", "s"), (202, "ja " * 5, "s"),
                          (203, "x " + "a b " * 4 + "a c c c c c c", "s"), (204, ("la la lu " * 4 + "end ") * 4, "s"),
                          (205, "a b " * 7, "s"), (206, loop, "s"), (206, loop, "s")]
    rows += [(i, " ".join(f"w{k % 11}" for k in range(i)), "s") for i in range(300, 360)]
    path = str(tmp_path / "documents.parquet")
    frame(llm, rows).write.parquet(path)
    got = periodic_runs.op11_periodic_runs(llm, str(tmp_path)).collect()
    want = []
    for i, t, _ in rows:
        w = planted(i, WORD.findall(t or ""))
        runs = brute_runs(w) if len(w) < 5000 else []
        keep = [x for k, x in enumerate(w) if not any(s + p <= k < s + m for s, m, p in runs)]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want.append((i, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
                     hashlib.sha256(" ".join(keep).encode()).hexdigest()))
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(map(repr, want))
    assert sum(r.n_runs for r in got) > 20


def test_a_long_text(llm):
    text = " ".join(["refrain of a long song"] * 40000)  # 200,000 words, above one turn of a batch
    r = periodic_runs.periodic_runs(frame(llm, [(1, text, "s"), (2, "short", "s")])).filter("doc_id = 1").first()
    assert [tuple(x) for x in r.runs] == [(0, 200000, 5)] and r.collapsed == "refrain of a long song" and r.n_words == 200000


def test_empty_table_and_bad_limits(llm):
    docs = frame(llm, hard_rows()).limit(0)
    assert periodic_runs.digests(periodic_runs.periodic_runs(docs)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, min_exponent=1)
