"""Token output, decontamination, WARC, the classifiers and word hashing."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clutchforge.llm import decontaminate, quality, textkit, token_output, toxicity, warc
from clutchforge.llm.common import scratch
from clutchforge.llm.labelled import training_rows

from .conftest import frame, hard_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ words
@given(st.lists(st.text(alphabet="aB1 \t\n.é漢!\x0b", max_size=30), min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_words_by_regex(texts):
    for pattern, kind in ((ALNUM, textkit.ALNUM), (re.compile(r"[^\x20\x09-\x0D]+"), textkit.NOT_SPACE)):
        w = textkit.words(texts, kind)
        want = [pattern.findall(t.translate(LOWER)) for t in texts]
        got = [[w.word(k).decode() for k in range(w.bounds[i], w.bounds[i + 1])] for i in range(len(texts))]
        assert got == want
        h = {}
        for word, x in zip([x for t in want for x in t], w.hashes.tolist()):
            assert h.setdefault(word, x) == x
        assert len(set(h.values())) == len(h)
        g, bounds = textkit.grams(w, 2)
        assert np.diff(bounds).tolist() == [max(0, len(t) - 1) for t in want]


def test_long_words_hash():
    w = textkit.words(["x" * 1000 + " " + "x" * 1000 + " " + "x" * 64 + " " + "x" * 65])
    assert w.hashes[0] == w.hashes[1] and len(set(w.hashes.tolist())) == 3


# ------------------------------------------------------------------ tokens
@pytest.fixture(scope="module")
def encoder():
    return token_output.Encoder(token_output.public_tokenizer())


@given(st.lists(st.text(alphabet="ab  \n\n\t.é'1  漢<|", max_size=40), max_size=5))
@settings(max_examples=200, deadline=None)
def test_segments_give_the_ids_of_whole_texts(encoder, texts):
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_cache_is_bounded_inside_a_batch(encoder, monkeypatch):
    monkeypatch.setattr(token_output, "CACHE_BYTES", 50 * (token_output.ENTRY_BYTES + 20))
    monkeypatch.setattr(token_output, "KNOWN_MARKS", 5)
    own = token_output.Encoder(token_output.public_tokenizer())
    texts = [" ".join(f"w{k}x{j}" + ".!"[j % 2] * j for j in range(20)) for k in range(30)] + ["x" * 20_000 + " y", "a" + "!" * 9000]
    assert own.encode(texts) == encoder.encode(texts)
    for cache in (own.rest, own.first):
        assert len(cache) <= 50 and len(cache.old) <= 50 and len(cache.known_marks) <= 5


def held_by_workers(spark, kind):
    """How many objects of a class the Python workers hold that run the next tasks."""
    def count(batches):
        import gc
        for pdf in batches:
            yield pdf.assign(id=sum(type(o).__name__ == kind for o in gc.get_objects()))

    return [r.id for r in spark.range(64).repartition(16).mapInPandas(count, "id long").distinct().collect()]


def test_workers_keep_no_encoder(llm):
    token_output.token_output(frame(llm, hard_rows())).count()
    assert held_by_workers(llm, "Encoder") == [0]


def test_workers_keep_no_index(llm):
    benchmark = llm.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.clean(frame(llm, hard_rows()), benchmark).count() > 0
    assert held_by_workers(llm, "SuffixAutomaton") == [0]


def library_ids(texts):
    """Whole texts through the tokenizers library itself."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_output.public_tokenizer())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


ODD = ["it's THEY'LL we've", "1234567 3.14 1,000", "tab\there", "  two  spaces ", "line\r\nends\r\n\r\n", "naïve façade Œuvre", "漢字かな交じり文 한국어",
       "👩‍👩‍👧 emoji 🇩🇪", "\u00a0no-break\u2003space", "a" * 3000, "!!!???...", "x_y-z/w\\v", "<|endoftext|> <s>", "\x00\x01\x7f", "ﬁ ligature Å Å",
       "مرحبا بالعالم", "ǅ ɐɥ ʼn", "e\u0301 combining", "\ud7ff\ue000", "word" + "." * 40 + " next", "UPPER lower MiXed 42nd"]


@given(st.lists(st.text(max_size=60), max_size=4))
@settings(max_examples=150, deadline=None)
def test_any_text_has_the_ids_of_the_library(encoder, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == library_ids(texts)


def test_token_files(llm):
    rows = hard_rows() + [(900 + k, t, "s") for k, t in enumerate(ODD)]
    folder = scratch(llm, "test-tokens")
    files = token_output.write_tokens(frame(llm, rows), folder, token_output.public_tokenizer(), frame_ids=500)
    placed = files.collect()
    read = token_output.read_tokens(files).collect()
    by_id = {}
    for (i, _, _), own in zip(rows, library_ids([t or "" for _, t, _ in rows])):
        ids = np.array([*own, 0], "<u4").tobytes()
        by_id.setdefault(i, []).append((len(ids) // 4, zlib.crc32(ids)))
    got = {}
    at = 0
    order = []
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        order.append(-1 if r.doc_id is None else r.doc_id)
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert order == sorted(order)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_id.items()}
    # a reader decompresses only the frames it needs
    for f in placed:
        reader = token_output.SeekableReader(f.file)
        wanted = [r.doc_id for r in read if r.doc_id == 105]
        found = list(reader.documents(wanted))
        if len(reader.frames) > 2:
            assert reader.decompressed < len(reader.frames)
        for d, ids in found:
            assert d == 105 and len(ids) == by_id[105][0][0]
        reader.close()


def test_a_spoiled_frame_is_found(tmp_path):
    path = tmp_path / "x.zst"
    with open(path, "wb") as out:
        w = token_output.SeekableWriter(out)
        w.add([(1, b"\1\0\0\0")])
        w.finish()
    data = bytearray(path.read_bytes())
    data[-10] ^= 1  # the checksum in the seek table
    path.write_bytes(bytes(data))
    with pytest.raises(ValueError):
        token_output.SeekableReader(str(path)).frame(0)


def test_no_documents(llm):
    assert token_output.token_output(frame(llm, hard_rows()).limit(0)).count() == 0


# ------------------------------------------------------------------ decontamination
def hits_by_brute_force(texts, items, window=10):
    out = []
    split = [(str(i) if i is not None else "", ALNUM.findall((t or "").translate(LOWER))) for i, t in items]
    for t in texts:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for name, b in split:
            n = min(window, len(b))
            if not n:
                continue
            grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    ids.add(name)
        out.append((len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("seed, block", [(1, 100_000), (2, 100_000), (3, 30)])
def test_decontamination_by_brute_force(llm, monkeypatch, seed, block):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(6)]  # few words: many overlapping matches
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(k, say(r.randint(4, 14))) for k in range(6)] + [(7, "!!"), (8, None), (None, say(11)), (9, "w1 w2 w3 w4 Ä")]
    items += [(1, items[1][1]), (10, items[2][1])]
    rows = [(i, say(r.randint(0, 200)), "s") for i in range(30)]
    rows += [(40 + k, f"{say(5)} x, {items[k][1].upper()}; {say(4)}", "s") for k in range(6)]
    rows += [(60, None, "s"), (61, "", "s"), (62, "W1-w2\nw3 w4 Ä!", "s"), (None, items[0][1], None)]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    docs = frame(llm, rows)
    got = decontaminate.find_contamination(docs, benchmark).collect()
    want = hits_by_brute_force([t for _, t, _ in rows], items)
    key = lambda d: -1 if d is None else d
    assert sorted((key(g.doc_id), g.n_words, sum(g.spans[1::2]) - sum(g.spans[::2]), list(g["items"])) for g in got) \
        == sorted((key(i), *x) for (i, _, _), x in zip(rows, want))
    cleaned = decontaminate.clean(docs, benchmark, max_coverage=1.0, chars_col="n_chars")
    assert cleaned.columns == docs.columns
    left = cleaned.collect()
    assert len(left) == len(rows) and all(x[1] == 0 for x in hits_by_brute_force([c.text for c in left], items))
    before = {key(i): t for i, t, _ in rows}
    for c in left:
        assert c.n_chars == (None if c.text is None else len(c.text))
        if dict(zip((key(i) for i, _, _ in rows), want))[key(c.doc_id)][1] == 0:
            assert c.text == before[key(c.doc_id)]
    assert decontaminate.find_contamination(docs, benchmark.limit(0)).filter("size(spans) > 0").count() == 0
    assert decontaminate.find_contamination(docs.limit(0), benchmark).count() == 0


def test_coverage_limit(llm):
    benchmark = llm.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = frame(llm, [(1, "a b c d e f g h i j k", "s"), (2, "a b c d e f g h i j " + "k " * 90, "s"), (3, "k", "s")])
    left = {r.doc_id: r.text for r in decontaminate.clean(docs, benchmark, max_coverage=0.5).collect()}
    assert set(left) == {2, 3} and left[2].split() == ["k"] * 90


@pytest.mark.parametrize("max_match, max_coverage", [(0, 0.5), (4, 0.8)])
def test_blocks_do_not_change_what_is_cleaned(llm, monkeypatch, max_match, max_coverage):
    r = random.Random(7)
    say = lambda n: " ".join(f"x{r.randrange(10_000)}" for _ in range(n))
    items = [(k, say(30)) for k in range(12)]
    items += [(20 + k, " ".join(items[k][1].split()[:3])) for k in range(4)]  # short items inside longer ones
    half = lambda k: (" ".join(items[k][1].split()[:5]), " ".join(items[k][1].split()[5:10]))
    rows = [(k, f"{say(20)} {items[k][1]} {items[j][1]} {say(20)}", "s") for k in range(12) for j in range(k)]
    rows += [(200 + k, f"{say(60)} {half(k)[0]} {items[j][1]} {half(k)[1]} {say(60)}", "s") for k in range(12) for j in range(k)]
    rows += [(400 + k, f"{say(9)} {' '.join(items[k][1].split()[:n])} {say(9)}", "s") for k in range(4) for n in (3, 4, 5)]
    rows += [(500, None, "s"), (501, say(30), "s")]
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    docs = frame(llm, rows)
    clean = lambda: sorted((c.doc_id, c.text, c.n_chars) for c in decontaminate.clean(
        docs, benchmark, max_match=max_match, max_coverage=max_coverage, chars_col="n_chars").collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 10**6)
    want = clean()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    got = clean()
    assert len(want) < len(rows) or max_coverage > 0.5
    assert got == want


@pytest.mark.parametrize("max_match", [0, 25])
def test_a_long_item_is_dealt_to_blocks(llm, monkeypatch, max_match):
    r = random.Random(11)
    long = [f"y{r.randrange(10 ** 6)}" for _ in range(2000)]
    items = [(1, " ".join(long)), (2, "short item"), (3, " ".join(long[500:530]))]
    rows = [(k, " ".join(["z"] * 9 + long[at:at + n] + ["z"] * 9), "s") for k, (at, n) in enumerate(
        [(0, 10), (95, 10), (99, 26), (100, 30), (1970, 30), (1991, 9), (540, 300), (500, 30), (90, 27)])]
    rows += [(50, "A short   item", "s"), (51, None, None), (52, "", "s")]
    benchmark, docs = llm.createDataFrame(items, "item_id long, text string"), frame(llm, rows)
    found = lambda: sorted((f.doc_id, f.n_words, list(f.spans), list(f["items"])) for f in
                           decontaminate.find_contamination(docs, benchmark).collect())
    clean = lambda: sorted((c.doc_id, c.text) for c in
                           decontaminate.clean(docs, benchmark, max_match=max_match, max_coverage=1.0).collect() if c.text)
    want = found(), clean()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert decontaminate.ItemBlocks(benchmark, 10).count > 10
    assert (found(), clean()) == want
    assert sum(bool(s) for _, _, s, _ in want[0]) == 9


def test_texts_are_read_once(llm):
    benchmark = llm.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = frame(llm, hard_rows(n=5))
    for df in (decontaminate.clean(docs, benchmark, chars_col="n_chars"),
               decontaminate.find_contamination(docs, benchmark).filter("size(spans) > 0")):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_a_text_above_one_turn(llm):
    benchmark = llm.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    long = "word " * 500_000 + "a b c d e f g h i j " + "word " * 9
    got = decontaminate.find_contamination(frame(llm, [(1, long, "s"), (2, "a b c", "s")]), benchmark)
    assert {r.doc_id: (r.n_words, list(r.spans)) for r in got.collect()} == {1: (500_019, [500_000, 500_010]), 2: (3, [])}


# ------------------------------------------------------------------ WARC
def test_warc_round_trip(llm):
    long = "<p>ä</p>" * 40
    rows = [(5, "http://a/%41 b?x=ü&y", long), (3, "http://b", long), (3, "http://b", long), (9, None, None), (1, "u", "short"),
            (2, "u", "short"), (None, "\r\nWARC/1.1", long), (None, "x", "other " * 50), (7, "http://c", "other " * 50)]
    pages = llm.createDataFrame([(*r, "t", 1, "d") for r in rows],
                                "page_id long, url string, html string, type string, uid int, digest string")
    ranges = warc.archive(pages, scratch(llm, "test-warc"))
    records = warc.read_records(ranges)
    assert records.count() == 3 * len(rows)
    got = warc.assemble(records).collect()
    ids = {r.capture_id: r for r in got}
    assert len(got) == len(rows)
    key = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted((key((r.metadata.page_id, r.target_uri)) for r in got)) == sorted(key(r[:2]) for r in rows)
    for r in got:
        assert r.request.target_uri == r.target_uri
        main = r if r.type == "response" else ids[r.refers_to]
        assert main.type == "response" and main.payload_digest == r.payload_digest and main.payload_bytes == r.payload_bytes
        html = bytes(main.payload).decode()
        assert html in {x[2] or "" for x in rows if x[0] == r.metadata.page_id}
        if r.type == "revisit":
            assert main.metadata.page_id == (3 if html == long else 7)
    assert sum(r.type == "revisit" for r in got) == 4
    assert warc.assemble(warc.read_records(warc.archive(pages.limit(0), scratch(llm, "test-warc")))).count() == 0


# ------------------------------------------------------------------ classifiers
def _labelled(seed=1, n=240):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("al", "en", "is", "or", "um", "at")]
    say = lambda k: " ".join(r.choice(words) for _ in range(k)).capitalize() + "."
    rows, labels = [], []
    for i in range(n):
        bad, rude = i % 4 == 0, i % 5 == 0
        text = " ".join(w.upper() + "!!" for w in say(30).split()) if bad else say(r.randint(10, 60))
        if rude:
            text += " you idiot, what a pathetic loser you are. " + say(8)
        rows.append((i, text, "s"))
        labels.append((i, int(not bad), int(rude), "x"))
    return rows, labels


def features_by_brute_force(text):
    """A text's n-grams, each with its share, by kind."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    plain = [w.translate(LOWER) for w in words]
    signs = lambda w: "".join("X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" or ord(c) > 127 else "9" if "0" <= c <= "9" else c
                              for c in w)
    shapes = [re.sub(r"(.)\1+", r"\1", signs(w)) for w in words]
    out = []
    for kind, of in enumerate((plain, shapes)):
        for n in (1, 2):
            grams = [tuple(of[k:k + n]) for k in range(len(of) - n + 1)]
            for g in grams:
                out.append(((kind, g), quality.SCALE / len(grams)))
    return out


def _by_place(places, values):
    out = {}
    for p, v in zip(places.tolist(), values.tolist()):
        out[p] = out.get(p, 0.0) + v
    return out


NASTY = ["", "x", "THEY!! they?? 12 1234\n\nÄÖ  漢字字 ok", "a a a a b", " \t\n", "end\vof\rline\fhere Now", "AAA bbb" * 50]


def test_features_by_brute_force():
    """Equal grams share a place and different ones don't (but for rare chance); shares add up."""
    place, value, row = quality.features(NASTY)
    for t, text in enumerate(NASTY):
        got = sorted(np.round(value[row == t], 12).tolist())
        want = features_by_brute_force(text)
        assert got == sorted(round(v, 12) for _, v in want)
        shares = {}
        for g, v in want:
            shares[g] = shares.get(g, 0.0) + v
        assert sorted(np.round(list(_by_place(place[row == t], value[row == t]).values()), 9)) == sorted(np.round(list(shares.values()), 9))


@pytest.mark.parametrize("limit", [1, 7, 40, 10 ** 6])
def test_features_of_long_texts(limit):
    r = random.Random(3)
    texts = NASTY + [" ".join(r.choice(["Of", "to", "9", "x!!", "ü"]) + r.choice(["", "\n", "  "]) for _ in range(300)) for _ in range(3)]
    for text in texts:
        place, value, _ = quality.features([text])
        want = _by_place(place, value)
        got = _by_place(*quality.long_features(text, limit))
        assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def toxicity_features_by_brute_force(text, learned, stems):
    raw, n_bytes = text, len(text.encode())
    words = ALNUM.findall(text.translate(LOWER))
    n = max(1, len(words))
    bad = [w in toxicity.LEXICON for w in words]
    taught = [w in learned or (len(w.encode()) > toxicity.STEM_BYTES and w.encode()[:toxicity.STEM_BYTES] in stems) for w in words]
    you = [w in toxicity.SECOND_PERSON for w in words]
    near = [any(you[j] for j in range(max(0, i - toxicity.NEAR), min(len(words), i + toxicity.NEAR + 1)) if j != i) for i in range(len(words))]
    upper, letters = re.findall("[A-Z]", raw), re.findall("[A-Za-z]", raw)
    shouted = [m for m in ALNUM.finditer(raw.translate(LOWER)) if m.end() - m.start() >= 2 and re.fullmatch("[A-Z]+", raw[m.start():m.end()])]
    signs = re.findall(r"[\x00-\x08\x0e-\x1f\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", raw)
    read = raw.translate(LOWER).translate({ord(k): v for k, v in toxicity.SIGNS.items()})
    hidden = sum(w in toxicity.LEXICON or w in learned for w in ALNUM.findall(read)) - sum(b or w in learned for b, w in zip(bad, words))
    kinds = lambda flags: len({w for w, f in zip(words, flags) if f})
    return [sum(bad) / n, sum(bad), kinds(bad), sum(taught) / n, sum(taught), kinds(taught),
            sum((b or t) and c for b, t, c in zip(bad, taught, near)) / n, sum(you) / n, len(upper) / max(1, len(letters)), len(shouted) / n,
            len(signs) / max(1, n_bytes), raw.count("!") / max(1, n_bytes), max(0, hidden) / n, float(np.log1p(len(words)))]


def test_toxicity_features_by_brute_force():
    r = random.Random(6)
    pool = ["you", "idiot", "1d10t", "STUPID", "zorp", "zorpling", "zorplex", "u", "fine", "Very", "ok!!", "b@st@rd", "dumb,dumber", "du", "été", "x"]
    texts = ["", " ", "!!!", "you you", "A", "YOU ARE AN IDIOT"] + [" ".join(r.choice(pool) for _ in range(r.randint(1, 40))) for _ in range(200)]
    learned, stems = ["zorp", "fine"], [b"zorpl", "étéx".encode()[:5]]
    at = np.arange(0, 10, 5)
    hashed = np.sort(textkit.hash_slices(np.frombuffer(b"".join(stems), dtype=np.uint8), at, at + 5))
    got = toxicity.features(texts, toxicity.word_hashes(learned), hashed)
    want = np.array([toxicity_features_by_brute_force(t, learned, stems) for t in texts])
    assert got.shape == (len(texts), len(toxicity.NAMES))
    for k, name in enumerate(toxicity.NAMES):
        assert np.allclose(got[:, k], want[:, k]), name


def test_learned_lexicon_by_brute_force(llm):
    r = random.Random(9)
    words = [f"{a}{b}{c}" for a in ("gra", "blo", "sni") for b in ("ck", "mp", "ffle") for c in ("", "ing", "ers")]
    rows = [(k, int(r.random() < 0.4), " ".join([*(r.choice(words) for _ in range(9)), *(["grackers"] if k % 3 == 0 else [])])) for k in range(200)]
    rows = [(k, int(y or "grackers" in t), t) for k, y, t in rows]
    got = toxicity.learn_lexicon(llm.createDataFrame(rows, "doc_id long, label int, text string"))
    total = {y: sum(x[1] == y for x in rows) for y in (0, 1)}

    def telling(entries):
        odds = {}
        for e in {e for _, _, t in rows for e in entries(t)}:
            labels = [y for _, y, t in rows if e in entries(t)]
            a, n = sum(labels), len(labels)
            odd = np.log((a + 0.5) / (total[1] + 1)) - np.log((n - a + 0.5) / (total[0] + 1))
            if a >= 4 and odd > 3:
                odds[e] = odd * a
        return sorted(sorted(odds, key=lambda e: (-odds[e], e))[:toxicity.LEARNED_WORDS])

    assert got == (telling(lambda t: set(t.split())), [s.encode() for s in telling(lambda t: {w[:5] for w in t.split() if len(w) > 5})])
    assert got[0] == ["grackers"]


def test_ftrl_by_brute_force():
    """The update rule of the method, weight by weight in plain Python."""
    rows, labels = _labelled(n=40)
    texts = [t for _, t, _ in rows] + ["", None]
    marks = [x[1] for x in labels] + [1, 0]
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.02
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - (l1 if zi > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    model = quality.Ftrl()
    for _ in range(2):
        model.learn(texts, marks)
        for text, y in zip(texts, marks):
            x = _by_place(*quality.features([text or ""])[:2])
            x[1 << quality.BITS] = 1.0
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                step = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = model.weights()
    assert model.rows == 84 and max(abs(got[i] - weight(i)) for i in z) < 1e-9
    assert not got[[i for i in range(len(got)) if i not in z]].any()


def test_training_streams_its_shards(llm, monkeypatch):
    """A shard's rows in hash order, all epochs, batch by batch: the weights of learning them at once."""
    rows, labels = _labelled(n=120)
    table = llm.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    chosen = training_rows(frame(llm, rows + [(-5, "long " * 300_000, "s")]), table.union(llm.createDataFrame([(-5, 1, 0, "x")], table.schema)),
                           "quality", 4, 2, 1000)
    from pyspark.sql import functions as F
    order = chosen.select("text", "label", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)).alias("s"),
                          F.xxhash64(F.lit(4), "doc_id").alias("o")).orderBy("o").collect()
    monkeypatch.setattr(quality, "SHARD_ROWS", -(-len(order) // 3))
    parts = []
    for s in range(3):
        model = quality.Ftrl()
        for _ in range(2):
            model.learn([r.text for r in order if r.s == s], [r.label for r in order if r.s == s])
        parts.append((model.weights().astype("<f4"), model.rows))
    want = np.average([w for w, _ in parts], axis=0, weights=[n for _, n in parts])
    assert np.allclose(quality.train(chosen, epochs=2), want, atol=1e-6)


def _accuracy(got, labels, column):
    known = {x[0]: x[column] for x in labels}
    held = [g for g in got if g.held_out and g.doc_id in known]
    assert len(held) > 30
    return sum(g.predicted == known[g.doc_id] for g in held) / len(held)


@pytest.mark.parametrize("run, folds, held, column", [(quality.classify_quality, 4, 2, 1), (toxicity.score_toxicity, 3, 1, 2)])
def test_classifiers_on_held_out_rows(llm, run, folds, held, column):
    rows, labels = _labelled()
    labels += [(0, None, None, "x"), (None, 1, 1, "x"), (5000, 1, 0, "x")]  # nulls and unknown documents
    rows += hard_rows(n=2)[2:] + [(10_000 + k, t, "s") for k, t in enumerate(["", None, "\n", "!?"])]
    table = llm.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    got = run(frame(llm, rows), table).collect()
    assert len(got) == len(rows)
    assert all(0.0 <= g.score <= 1.0 and g.predicted == int(g.score >= 0.7) for g in got)
    assert all(g.held_out == (zlib.crc32(str(g.doc_id if g.doc_id is not None else "").encode()) % folds == held) for g in got)
    assert _accuracy(got, labels, column) > 0.95
    # labels of held-out rows have no say
    turned = [(i, *[(1 - q if i is not None and zlib.crc32(str(i).encode()) % folds == held and q is not None else q) for q in x])
              for i, *x in [(a, b, c) for a, b, c, _ in labels]]
    again = run(frame(llm, rows), llm.createDataFrame([(*t, "x") for t in turned], "doc_id long, quality int, toxic int, text string"))
    assert sorted((str(g.doc_id), round(g.score, 9)) for g in got) == sorted((str(g.doc_id), round(g.score, 9)) for g in again.collect())


@pytest.mark.parametrize("run", [quality.classify_quality, toxicity.score_toxicity])
def test_classifiers_without_labels_or_rows(llm, run):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(llm, hard_rows(n=3))
    assert len({round(r.score, 6) for r in run(docs, none).collect()}) == 1
    assert run(docs.limit(0), none).count() == 0


def test_training_sample_is_bounded(llm):
    rows, labels = _labelled()
    table = llm.createDataFrame(labels + labels, "doc_id long, quality int, toxic int, text string")
    got = training_rows(frame(llm, rows + rows), table, "quality", 4, 2, 50).collect()
    assert len(got) == len({g.doc_id for g in got}) == 50
