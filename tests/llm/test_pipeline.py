"""Registered queries against their SQL, and the pipeline against brute force."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from clutchforge.llm import registry
from oracle.check import compare, duck

from ..conftest import SF_SMALL
from .conftest import frame, hard_rows
from .test_dedup import components_by_brute_force
from .test_text_ops import hits_by_brute_force


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(llm, name):
    got = registry.queries()[name](llm, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(registry.oracle_sql()[name]).df()
    r = compare(got, want)
    assert r["match"], r


def test_one_query_per_operator():
    names = [n.split("_")[0] for n in registry.queries()]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 14))
    assert set(corpus_pipeline.queries()) == {"pipeline"}


@pytest.fixture(scope="module")
def fixture(tmp_path_factory):
    """A small corpus: part of the documents and all they need, as tables of their own."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"copy (select * from read_parquet('{SF_SMALL}/{t}.parquet')) to '{folder}/{t}.parquet'")
    return folder


def test_pipeline_stage_by_stage(llm, fixture, tmp_path):
    docs = llm.read.parquet(f"{fixture}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontaminate", "mix", "tokens"]
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{fixture}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(str(tmp_path), name)
        stage(llm, docs, fixture).write.parquet(path)
        before, docs = docs, llm.read.parquet(path)
        if name != "tokens":
            assert docs.columns == columns
        seen[name] = (before.collect(), docs.collect())

    before, after = seen["quality"]
    scores = registry.queries()["op10_quality"](llm, fixture).collect()
    assert {r.doc_id for r in after} == {r.doc_id for r in scores if r.predicted == 1}

    before, after = seen["near_copies"]
    want, components = components_by_brute_force([(r.doc_id, r.text, None) for r in before], 5, 80)
    assert len(after) == components and {r.doc_id for r in after} == {c for _, _, c in want}

    before, after = seen["decontaminate"]
    hits = dict(zip([r.doc_id for r in before], hits_by_brute_force([r.text for r in before], items)))
    kept = {r.doc_id: r for r in after}
    assert set(kept) == {i for i, (n, hit, _) in hits.items() if hit <= 0.5 * n}
    assert all(x[1] == 0 for x in hits_by_brute_force([r.text for r in after], items))
    assert all(kept[r.doc_id].text == r.text for r in before if not hits[r.doc_id][1])
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = seen["mix"]
    size = {r.doc_id: len(r.text.split()) for r in before}
    taken = sum(size[r.doc_id] for r in after)
    assert abs(taken - 1.5 * sum(size.values())) <= sum(
        max(size[r.doc_id] for r in before if r.source == s) for s in {r.source for r in before})
    copies = [sum(r.doc_id == i for r in after) for i in size]
    assert max(copies) <= 2

    before, after = seen["tokens"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    assert sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)


def hard_documents(llm, folder):
    """Nulls everywhere, empty and very long texts, ties, near copies, repeated rows, columns of clashing names."""
    rows = hard_rows(n=60) + [(700, "Good words and more. " * 60_000, "s0"), (701, None, "s1"), (None, None, None), (702, "tie " * 30, "s1"),
                              (703, "tie " * 30, "s1"), (704, "A b. " * 50, None), (704, "A b. " * 50, None), (704, "A b. " * 50, None)]
    items = [(1, " ".join(rows[3][1].split()[:12])), (None, "a null id with words of its own here and there"), (2, None), (3, "")]
    frame(llm, rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1 - i % 2 if i % 5 else None, 0) for i, t, _ in rows if i is not None and i < 60] + [(None, 1, 1), (None, None, None), (9999, 1, 0)]
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_on_hard_rows(llm, tmp_path):
    """Each stage on all hard rows: its own input, not what the stage before has left."""
    folder = str(tmp_path)
    rows, items = hard_documents(llm, folder)
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    out = {name: stage(llm, docs, folder) for name, stage in corpus_pipeline.STAGES}
    assert all(out[name].columns == docs.columns for name in out if name != "tokens")
    got = {name: df.collect() for name, df in out.items()}

    key = lambda i, t: (-1 if i is None else i, t or "", t is None)
    everything = Counter(key(i, t) for i, t, _ in rows)
    scores = Counter(key(r.doc_id, r.text) for r in got["quality"])
    assert scores <= everything and all(n == everything[k] for k, n in scores.items())  # equal rows share their fate

    want, components = components_by_brute_force(rows, 5, 80)
    empty = sum(not (t or "").split() for _, t, _ in rows)
    assert components == len(got["near_copies"]) and sum(not (r.text or "").split() for r in got["near_copies"]) == empty

    hits = Counter()
    for (i, t, _), (n, hit, _) in zip(rows, hits_by_brute_force([t for _, t, _ in rows], items)):
        hits[key(i, t)] += hit <= 0.5 * n
    assert len(got["decontaminate"]) == sum(hits.values())
    assert all(h == 0 for _, h, _ in hits_by_brute_force([r.text for r in got["decontaminate"]], items))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got["decontaminate"])

    assert sum(len((r.text or "").split()) for r in got["mix"]) > 0
    assert Counter(key(r.doc_id, r.text) for r in got["mix"]) <= everything + everything
    assert len(got["tokens"]) == len(rows)


def test_run_on_hard_rows_and_empty_tables(llm, tmp_path):
    folder = str(tmp_path / "hard")
    hard_documents(llm, folder)
    assert corpus_pipeline.run(llm, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for empty in ("documents", "labels", "benchmark"):
        other = str(tmp_path / f"no_{empty}")
        for t in ("documents", "labels", "benchmark"):
            df = llm.read.parquet(f"{folder}/{t}.parquet")
            (df.limit(0) if t == empty else df).write.parquet(f"{other}/{t}.parquet")
        n = corpus_pipeline.run(llm, other).count()
        assert n == 0 if empty in ("documents", "labels") else n > 0
