"""License scan, chat formatting and source mixing: DataFrame operators."""

import random
import re
from collections import defaultdict

import pytest

from clutchforge.llm import chat_format, license_scan, source_mix

from .conftest import frame, hard_rows

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def test_license_places_by_brute_force(llm):
    rows = hard_rows() + [
        (200, "GNU General Public License, version 3. The MIT-License; apache LICENSE apache license", "s0"),
        (201, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
              " documentation files the software to deal in the software without limits", "s0"),
        (202, "general public license gnu general public", "s0"), (203, "cc by cc by cc", "s0")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                 for r in license_scan.scan_licenses(frame(llm, rows)).collect())
    want = []
    for i, t, _ in rows:
        w = WORDS.findall((t or "").translate(LOWER))
        at = [(k, label) for label, p in BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        at = [(k, label) for k, label in at if len(w) - k >= len(BASE[label].split())]
        want.append((-1 if i is None else i, len(w), len(at), min((k for k, _ in at), default=None),
                     max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    assert got == sorted(want)


def test_license_method_labels_and_score(llm):
    rows = [(1, "licensed under the gnu general public license version 3", "s"), (2, "nothing here", "s"), (3, None, "s"),
            (4, "permission is hereby granted free of charge to nobody at all", "s")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(frame(llm, rows)).collect()}
    assert got[1].labels == "gpl,gpl-3.0" and got[1].score == 1.0 and got[1].base_labels == "gpl"
    assert got[2].labels == "" and got[2].score == 0.0 and got[3].n_words == 0
    assert got[4].labels == "" and 0 < got[4].score < 0.8  # the key phrase stands, most of the template doesn't
    assert license_scan.scan_licenses(frame(llm, rows).limit(0)).count() == 0


def test_whole_notices_by_brute_force(llm):
    """Notices whole, with words changed, cut off at either end, twice, and their words in another order."""
    r = random.Random(5)
    rows = []
    for t in license_scan.TEMPLATES:
        w = t.words
        changed = [x if r.random() > 0.1 or t.key_at <= k < t.key_at + len(t.key) else "changed" for k, x in enumerate(w)]
        for text in (w, changed, w[t.key_at:], w[:t.key_at + len(t.key)], w + ["and"] + w, sorted(w), ["x"] * 40 + w + ["y"] * 40):
            rows.append((len(rows), " ".join(text).upper(), "s"))
    words = [(i, WORDS.findall(t.translate(LOWER))) for i, t, _ in rows]
    scanned = license_scan.scan_licenses(frame(llm, rows)).collect()
    vocabulary = license_scan.vocabulary(license_scan.TEMPLATES)
    docs = {v: sum(v in w for _, w in words) for v in vocabulary}
    import math
    weight = {v: int(math.floor(1000 * math.log((len(rows) + 1) / (docs[v] + 1)))) + 1 for v in vocabulary}
    got = {x.doc_id: sorted((p.label, p.start, round(p.share, 9)) for p in x.places) for x in scanned}
    for i, w in words:
        want = []
        for t in license_scan.TEMPLATES:
            for s in range(len(w) - len(t.key) + 1):
                if w[s:s + len(t.key)] == t.key:
                    start = s - t.key_at
                    here = sum(weight[x] for j, x in enumerate(t.words) if 0 <= start + j < len(w) and w[start + j] == x)
                    share = here / sum(weight[x] for x in t.words)
                    if share >= license_scan.MIN_SHARE:
                        want.append((t.label, start, round(share, 9)))
        assert got[i] == sorted(want)
    assert sum(len(x) for x in got.values()) > 150


def _conversations(llm, rows):
    return llm.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, own string")


def test_chat_round_trip(llm):
    nasty = ["\\### Assistant: </turn> ok", "<turn user>\n", "\\l\\b<\\", "", None, "\n</turn>\n", "a\\", "é <turn system>\nx"]
    rows = [(1, k, ["system", "user", "assistant"][k % 3] if k else "system", nasty[k % len(nasty)], "w", "o") for k in range(30)]
    rows += [(2, 0, "assistant", "word " * 3000, "w", "o"), (2, 1, "we>ird\nrole<", "x", "w", "o"), (2, 1, None, None, "w", "o"),
             (2, 1, None, None, "w", "o"), (None, None, "user", "no ids", "w", "o"), (3, 0, "assistant", "only", "w", "o")]
    rows += [(4, k, ["user", "assistant"][k % 2], f"turn {k} " + "word " * (k % 40), "w", "o") for k in range(300)]
    windows = chat_format.format_windows(_conversations(llm, rows), budget=128, history=32).collect()
    got = {r.conv_id: r for r in chat_format.read_windows(llm.createDataFrame(
        windows, "conv_id long, window long, text string, loss array<struct<from:int,chars:int>>, tokens long, "
                 "repeated int, over_budget boolean")).collect()}
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    for c, all_ in turns.items():
        all_.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in all_]
        assert list(got[c].targets) == [x for _, r, x in all_ if r == "assistant"]
    fits = {c for c in turns if c != 2}  # one turn of 3,000 words doesn't
    assert all(w.tokens <= 128 for w in windows if w.conv_id in fits) and sum(w.over_budget for w in windows) == 1
    many = [w for w in windows if w.conv_id == 4]
    assert len(many) > 10 and any(w.repeated for w in many)
    assert all(w.over_budget == (w.tokens > 128) for w in windows)
    assert all(w.text.startswith("<turn system>") for w in windows if w.conv_id == 1)


def windows_by_brute_force(turns, budget, history):
    """(own, repeated) turn numbers of the windows of turns (role, tokens), one after the other."""
    lead = turns[0][1] if turns and turns[0][0] == "system" else 0
    out, own, size = [], [], 0
    for i, (_, n) in enumerate(turns):
        used = 0 if i == 0 and lead else n
        if own and size + used > max(0, budget - history - lead):
            out.append(own)
            own, size = [], 0
        own.append(i)
        size += used
    out.append(own)
    windows = [(out[0], [])]
    for before, own in zip(out, out[1:]):
        left, again = min(history, budget - lead - sum(turns[i][1] for i in own)), []
        for i in reversed(before):
            if (i == 0 and lead) or turns[i][1] > left:
                break
            again.insert(0, i)
            left -= turns[i][1]
        windows.append((own, ([0] if lead else []) + again))
    return windows


@pytest.mark.parametrize("budget, history, system", [(1024, 256, 0), (1024, 256, 40), (100, 30, 20), (100, 0, 0), (100, 30, 90), (60, 50, 5)])
def test_windows_keep_the_budget(llm, budget, history, system):
    r = random.Random(budget + system)
    sizes = {1: [600] * 8, 2: [r.randrange(1, 90) for _ in range(120)], 3: [budget - 4, 1, budget - 4, 1], 4: [1], 5: [budget * 3, 5, 5]}
    rows, plan = [], {}
    for c, words in sizes.items():
        turns = [("system", system - 4)] if system else []
        turns += [(["user", "assistant"][k % 2], n) for k, n in enumerate(words)]
        plan[c] = [(role, n + 4) for role, n in turns]
        rows += [(c, k, role, " ".join(f"t{k}" for _ in range(n)), "w", "o") for k, (role, n) in enumerate(turns)]
    windows = chat_format.format_windows(_conversations(llm, rows), budget, history).collect()
    for c, turns in plan.items():
        got = sorted((w for w in windows if w.conv_id == c), key=lambda w: w.window)
        want = windows_by_brute_force(turns, budget, history)
        assert [(w.repeated, w.tokens) for w in got] == [(len(again), sum(turns[i][1] for i in own + again)) for own, again in want]
        lead = turns[0][1] if system else 0
        for w, (own, _) in zip(got, want):
            assert w.over_budget == (w.tokens > budget)
            assert w.tokens <= budget or (len([i for i in own if i or not lead]) == 1 and lead + turns[own[-1]][1] > budget)


def test_cells_cut_a_long_conversation(llm, monkeypatch):
    monkeypatch.setattr(chat_format, "CELL_BUDGETS", 2)
    rows = [(1, k, ["user", "assistant"][k % 2], "word " * (k % 23), "w", "o") for k in range(400)]
    windows = chat_format.format_windows(_conversations(llm, rows), budget=100, history=20)
    assert windows.filter("tokens > 100").count() == 0
    read = chat_format.read_windows(windows).first()
    assert [(t.role, t.text) for t in read.turns] == [(role, text) for _, _, role, text, *_ in rows]


def test_chat_empty(llm):
    assert chat_format.read_windows(chat_format.format_windows(_conversations(llm, []))).count() == 0


def test_mix_targets_and_rounding(llm):
    rows = hard_rows(n=400)
    got = source_mix.mix_sources(frame(llm, rows)).collect()
    assert len(got) == len(rows)
    size, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size and isinstance(r.copies, int)
    total = sum(size.values())
    order = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want, full = {}, set()
    while True:  # the contract, step by step
        left = 1.5 * total - sum(2 * size[s] for s in full)
        want = {s: 2.0 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in size if x not in full) for s in size}
        over = {s for s in size if s not in full and want[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    assert all(abs(want[s] - target[s]) < 1e-6 * total for s in size)
    assert all(r.source_size == size[r.source] for r in got)
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in size)
    key = lambda rs: sorted(((r.doc_id or -1), r.size, r.taken) for r in rs)
    assert key(got) == key(source_mix.mix_sources(frame(llm, rows[::-1])).collect())


def test_rounding_goes_through_the_tree(llm):
    items = llm.range(1000).selectExpr("'s' as source", "id as key", "1.0D + id % 50 as size", "0.1D + (id % 8) / 10.0D as p")
    out = {r.key: r.extra for r in source_mix.round_pivotal(items, block=8).collect()}
    assert sorted(out) == list(range(1000)) and set(out.values()) == {0, 1}
    want = sum((1 + k % 50) * (0.1 + (k % 8) / 10) for k in out)
    assert abs(sum((1 + k % 50) * x for k, x in out.items()) - want) <= 50


def test_mix_empty_and_rows(llm):
    docs = frame(llm, hard_rows())
    assert source_mix.mix_sources(docs.limit(0)).count() == 0
    assert source_mix.mixed(docs.limit(0)).count() == 0
    mixed = source_mix.mixed(docs)
    assert mixed.columns == docs.columns
    copies = sum(r.copies for r in source_mix.mix_sources(docs).collect())
    assert mixed.count() == copies


def test_a_row_repeated_very_often_is_taken_evenly(llm, monkeypatch):
    """A third of all rows are copies of one row, in many shares."""
    monkeypatch.setattr(source_mix, "SALTS", 7)
    rows = [(1, "a b c", "s")] * 200 + [(i, f"w{i} " * (i % 9), "s") for i in range(2, 400)] + [(None, "x y", None)] * 5
    docs = frame(llm, rows)
    copies = sorted(r.copies for r in source_mix.mix_sources(docs).collect() if r.doc_id == 1)
    assert len(copies) == 200 and copies[-1] - copies[0] <= 1
    mixed = source_mix.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.filter("doc_id = 1").count() == sum(copies)
    assert mixed.count() == sum(r.copies for r in source_mix.mix_sources(docs).collect())
