"""Benchmark decontamination with a generalised suffix automaton.

Items become word sequences (ASCII letters lower-cased; runs of letters, digits
and non-ASCII characters). A window is ``WINDOW`` consecutive words of an item,
or a shorter item as a whole. One automaton accepts every substring of all
items; streaming a document's words through it gives, at every word, the longest match
that ends there, and with it the windows that end there. Words inside an
occurrence of a window are hit.

Most words never reach the automaton: the 3-word hashes of a batch are looked up
among those of the items, and only runs of known ones that are long enough for
a window are streamed (every occurrence lies inside such a run), word for word,
so hash collisions cannot make a hit.

The items are a stated set; they are read and broadcast in blocks of about
``BLOCK_WORDS`` words, one after the other, with one pass over the documents each; every
task builds the block's automaton and frees it at its end. Documents are never shuffled (with
several blocks, only hits are).

``clean`` removes the spans whose match is longer than ``max_match`` words, and drops
documents of which more than ``max_coverage`` is hit.

Defined results: null texts have no words; items without words have no windows;
repeated items (and ids) count once per id; null item ids are named by the empty
string; repeated documents are scanned each; empty tables give no rows or no hits.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit
from ..operators.joins import broadcast_if_small
from .common import alnum_words, materialise, prepare, table, text_rows
from .workers import tidy

WINDOW = 10
BLOCK_WORDS = 100_000
SMALL = 8 << 20  # bytes of a table of row numbers that may be broadcast; larger ones are shuffled


class SuffixAutomaton:
    """All substrings of several sequences; ``mark`` names the windows of each."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of the strings of ``p`` followed by ``c``, apart from longer ones."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            if c in self.next[last]:
                last = self._split(last, c)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def step(self, state: int, length: int, c: int | None) -> tuple[int, int]:
        """The longest suffix of the read words that is a substring of an item."""
        if c is None:
            return 0, 0
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        state = self.next[state].get(c, 0)
        return state, (length + 1 if state else 0)

    def suffix(self, state: int, length: int) -> int:
        """The state that holds the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


class Index:
    """The windows of a block of items, ready to be found in texts."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        w = textkit.words([t for _, t in items], textkit.ALNUM)
        counts = w.counts
        self.shortest = int(min([window, *counts[counts > 0].tolist()])) if (counts > 0).any() else 0
        self.gram = min(3, self.shortest)
        self.vocabulary: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton()
        self.marks: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))  # state, length: ids
        if not self.shortest:
            return
        self.grams = np.unique(textkit.grams(w, self.gram)[0])
        sequences = []
        for i, (item_id, _) in enumerate(items):
            seq = [self.vocabulary.setdefault(w.word(k), len(self.vocabulary))
                   for k in range(w.bounds[i], w.bounds[i + 1])]
            self.automaton.add(seq)
            sequences.append((item_id, seq))
        a = self.automaton
        for item_id, seq in sequences:
            n, state, length = min(window, len(seq)), 0, 0
            for k, c in enumerate(seq):
                state, length = a.step(state, length, c)
                if k + 1 >= n:
                    self.marks[a.suffix(state, n)][n].add(item_id)
        # The nearest state with marks, going to ever shorter suffixes.
        self.marked = [0] * len(a.next)
        for s in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.marked[s] = s if s in self.marks else self.marked[a.link[s]]

    def runs(self, w: textkit.Words) -> Iterator[tuple[int, int, int]]:
        """(text, first word, end word) of the runs that may hold a window."""
        h, bounds = textkit.grams(w, self.gram)
        at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        known = self.grams[at] == h
        edge = np.zeros(len(h) + 1, dtype=bool)
        edge[bounds] = True
        hits = np.flatnonzero(known)
        if not len(hits):
            return
        new = np.concatenate([[True], (np.diff(hits) != 1) | edge[hits[1:]]])
        firsts = np.flatnonzero(new)
        lasts = np.concatenate([firsts[1:], [len(hits)]]) - 1
        first, size = hits[firsts], hits[lasts] - hits[firsts] + self.gram
        for f, n in zip(first[size >= self.shortest].tolist(), size[size >= self.shortest].tolist()):
            text = int(np.searchsorted(bounds, f, side="right")) - 1
            begin = int(w.bounds[text] + f - bounds[text])
            yield text, begin, begin + n

    def lengths(self, w: textkit.Words, at: list[list[int]]) -> list[list[int]]:
        """Per text: the longest match that ends before each of the places ``at`` (ascending, in words of the text)."""
        out = []
        for text, places in enumerate(at):
            state = length = done = 0
            first, found = int(w.bounds[text]), []
            for end in places:
                for k in range(first + done, first + end):
                    state, length = self.automaton.step(state, length, self.vocabulary.get(w.word(k)))
                done = end
                found.append(length)
            out.append(found)
        return out

    def find(self, w: textkit.Words, ends: list[list[int]] | None = None) \
            -> tuple[list[list[int]], list[set[str]], list[list[int]]]:
        """Per text: merged hit spans (first, end, first, end, ... in words of the
        text), the ids of items with a window in it, and each span's longest match.
        ``ends`` (a list per text) takes the places where windows end."""
        n = len(w.counts)
        spans, ids, longest = [[] for _ in range(n)], [set() for _ in range(n)], [[] for _ in range(n)]
        if not self.shortest:
            return spans, ids, longest
        a = self.automaton
        for text, begin, end in self.runs(w):
            state = length = 0
            for k in range(begin, end):
                state, length = a.step(state, length, self.vocabulary.get(w.word(k)))
                m, reach = self.marked[state], 0
                while m:
                    for size, items in self.marks[m].items():
                        if size <= length:
                            ids[text] |= items
                            reach = max(reach, size)
                    m = self.marked[a.link[m]]
                if reach:
                    if ends is not None:
                        ends[text].append(k + 1 - int(w.bounds[text]))
                    add_span(spans[text], longest[text], k + 1 - reach - int(w.bounds[text]),
                             k + 1 - int(w.bounds[text]), length)
        return spans, ids, longest


def add_span(spans: list[int], longest: list[int], first: int, end: int, match: int) -> None:
    """Add a span that ends last to merged spans; touching spans stay apart, overlapping ones join."""
    while spans and spans[-2] >= first:
        end = max(end, spans.pop())
        spans.pop()
        match = max(match, longest.pop())
    if spans and spans[-1] > first:
        spans[-1] = max(spans[-1], end)
        longest[-1] = max(longest[-1], match)
    else:
        spans += [first, end]
        longest.append(match)


def merge_spans(lists) -> list[int]:
    """The spans of several blocks as one block would give them."""
    flat: list[int] = []
    for end, first in sorted((int(s[i + 1]), int(s[i])) for s in lists for i in range(0, len(s), 2)):
        add_span(flat, [0] * len(flat), first, end, 0)
    return flat


def once(udf):
    """Evaluated once per row: the optimizer copies other functions into a filter on their result, which would read every text twice."""
    return udf.asNondeterministic()


FOUND = "n_words long, spans array<int>, items array<string>"


def finder(shared, window: int) -> Callable[[Column], Column]:
    """A column of FOUND for a text column."""
    @F.pandas_udf(FOUND)
    @tidy
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value, window)  # the task's own: it goes with the task
        for series in texts:
            out = []
            for _, part in textkit.pieces(series.tolist()):
                w = textkit.words(part, textkit.ALNUM)
                spans, ids, _ = index.find(w)
                out += [(int(n), s, sorted(i)) for n, s, i in zip(w.counts, spans, ids)]
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])
    return once(find)


def cleaner(shared, window: int, max_match: int, max_coverage: float) -> Callable[[Column], Column]:
    """The text without its long matches; null where more than ``max_coverage`` of the words is hit."""
    @F.pandas_udf("text string, changed boolean, dropped boolean")
    @tidy
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value, window)  # the task's own: it goes with the task
        for series in texts:
            out = []
            for _, part in textkit.pieces(series.tolist()):
                w = textkit.words(part, textkit.ALNUM)
                spans, _, longest = index.find(w)
                for i, text in enumerate(part):
                    hit = sum(spans[i][1::2]) - sum(spans[i][::2])
                    dropped = bool(hit) and hit > max_coverage * w.counts[i]
                    left = text if dropped or not hit else remove(index, text, max_match)
                    out.append((left, left != text, dropped))
            yield pd.DataFrame(out, columns=["text", "changed", "dropped"])
    return once(clean)


def remove(index: Index, text: str, max_match: int) -> str:
    """``text`` without spans whose match exceeds ``max_match`` words; again while closing a gap makes new ones."""
    while True:
        w = textkit.words([text], textkit.ALNUM)
        spans, _, longest = index.find(w)
        cuts = [(spans[0][2 * i], spans[0][2 * i + 1]) for i, m in enumerate(longest[0]) if m > max_match]
        if not cuts:
            return text
        text = cut_words(text, w, cuts)


def cut_words(text: str, w: textkit.Words, cuts: list[tuple[int, int]]) -> str:
    """``text``, whose words are ``w``, without the words of ``cuts`` and what is between them."""
    raw, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
    for first, end in cuts:
        kept.append(raw[at:w.starts[first]])
        at = int(w.ends[end - 1])
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


class ItemBlocks:
    """The items in blocks of about BLOCK_WORDS words. One block at a time is read to
    the driver and broadcast; ``close`` takes it away from there and from the workers.

    An item of more than twice as many words is dealt to blocks in parts that share ``overlap``
    words, so that every window, and every match of up to ``overlap`` words, lies in one of them."""

    def __init__(self, benchmark: DataFrame, overlap: int, id_col: str = "item_id", text_col: str = "text"):
        items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                                 F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
        # Words are fewer than half of the characters, and one.
        most = F.octet_length("text") / 2 + 1
        step = max(BLOCK_WORDS, overlap + 1)
        if items.filter(most > 2 * step).isEmpty():
            self.items = items
        else:
            words = items.filter(most > 2 * step).withColumn("w", alnum_words(F.col("text")))
            starts = F.sequence(F.lit(0), F.greatest(F.size("w") - overlap - 1, F.lit(0)), F.lit(step))
            parts = F.transform(starts, lambda at: F.array_join(F.slice("w", at + 1, F.lit(step + overlap)), " "))
            parts = words.select("id", F.explode(parts).alias("text"))
            self.items = materialise(items.filter(most <= 2 * step).unionByName(parts), "items")
        total = self.items.agg(F.sum(most)).first()[0] or 0
        self.count = max(1, math.ceil(total / BLOCK_WORDS))
        self.sc = benchmark.sparkSession.sparkContext

    def load(self, b: int):
        """The broadcast of the (id, text) list of block ``b``."""
        block = F.pmod(F.xxhash64("id", "text"), F.lit(self.count))
        return self.sc.broadcast(sorted((r["id"], r["text"]) for r in self.items.filter(block == b).collect()))

    def each(self, run: Callable[[object], DataFrame], tag: str) -> list[DataFrame]:
        """What ``run`` makes of every block, written one after the other."""
        out = []
        for b in range(self.count):
            shared = self.load(b)
            out.append(materialise(run(shared), tag))
            shared.destroy()
        return out


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def spans_merger() -> Callable[[str], Column]:
    @F.pandas_udf("array<int>")
    def merged(lists: pd.Series) -> pd.Series:
        return pd.Series([merge_spans(spans) for spans in lists])
    return merged


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, spans (merged, in words), items (sorted ids)."""
    blocks = ItemBlocks(benchmark, window)
    rows = text_rows(docs, id_col, text_col)
    if blocks.count == 1:
        found = rows.select("doc_id", finder(blocks.load(0), window)("text").alias("f"))
        return found.select("doc_id", "f.*")
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    hits = _union(blocks.each(lambda shared: rows.select("uid", finder(shared, window)("text").alias("f")).select("uid", "f.*")
                              .filter(F.size("spans") > 0).select("uid", "spans", "items"), "hits"))
    both = hits.groupBy("uid").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items")) \
        .select("uid", spans_merger()("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    everyone = rows.select("uid", "doc_id", F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    return everyone.join(both, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<int>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


HITS = "n_words long, spans array<int>, ends array<int>"


def hits_finder(shared, window: int) -> Callable[[Column], Column]:
    """A column of HITS for a text column; ``ends`` are the places where windows end."""
    @F.pandas_udf(HITS)
    @tidy
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value, window)  # the task's own: it goes with the task
        for series in texts:
            out = []
            for _, part in textkit.pieces(series.tolist()):
                w = textkit.words(part, textkit.ALNUM)
                ends: list[list[int]] = [[] for _ in part]
                spans, _, _ = index.find(w, ends)
                out += [(int(n), s, e) for n, s, e in zip(w.counts, spans, ends)]
            yield pd.DataFrame(out, columns=["n_words", "spans", "ends"])
    return once(find)


def lengths_finder(shared, window: int) -> Callable[[Column, Column], Column]:
    """A column of the longest matches with a block's items at the places ``ends`` of a text column."""
    @F.pandas_udf("array<int>")
    @tidy
    def lengths(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        index = Index(shared.value, window)  # the task's own: it goes with the task
        for texts, ends in columns:
            w = textkit.words(texts.tolist(), textkit.ALNUM)
            yield pd.Series(index.lengths(w, [e.tolist() for e in ends]), dtype=object)
    return lengths


def _hits(texts: DataFrame, blocks: ItemBlocks, window: int) -> DataFrame:
    """uid, n_words, spans and ends (both of all blocks) of the rows (uid, text) that are hit."""
    parts = blocks.each(lambda shared: texts.select("uid", hits_finder(shared, window)("text").alias("f")).select("uid", "f.*")
                        .filter(F.size("spans") > 0), "hits")
    return materialise(_union(parts).groupBy("uid").agg(
        F.first("n_words").alias("n_words"), F.collect_list("spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ends")))).alias("ends"))
        .withColumn("spans", spans_merger()("spans")), "merged")


def _cut(rows: DataFrame, blocks: ItemBlocks, window: int, max_match: int) -> DataFrame:
    """uid and text of the rows (uid, text, spans, ends) that lose spans."""
    if max_match > 0:  # a longer match may be with the items of a block that has no window there
        parts = blocks.each(lambda shared: rows.select("uid", lengths_finder(shared, window)("text", "ends").alias("l")), "lengths")
        longest = _union(parts).select("uid", F.posexplode("l").alias("at", "l")).groupBy("uid", "at").agg(F.max("l").alias("l")) \
            .filter(F.col("l") > max_match).groupBy("uid").agg(F.collect_list("at").alias("long"))
        rows = rows.join(longest, "uid").withColumn("long", F.transform("long", lambda i: F.col("ends")[i]))
    else:
        rows = rows.withColumn("long", F.col("ends"))

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series, long: pd.Series) -> pd.Series:
        out = []
        for text, s, at in zip(texts, spans, long):
            at = np.sort(at)
            cuts = [(int(f), int(e)) for f, e in zip(s[::2], s[1::2])
                    if np.searchsorted(at, f, side="right") < np.searchsorted(at, e, side="right")]
            out.append(cut_words(text, textkit.words([text], textkit.ALNUM), cuts))
        return pd.Series(out, dtype=object)

    return rows.select("uid", without("text", "spans", "long").alias("text"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_match: int = 0, max_coverage: float = 0.5,
          text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` (all columns) with matches longer than ``max_match`` words cut out of
    the texts and documents hit over ``max_coverage`` dropped. ``chars_col``: a
    column with the texts' lengths, to follow. With several blocks ``docs`` must be read from files
    (row numbers tie the passes); every round runs all blocks over the rows the last one cut."""
    blocks = ItemBlocks(benchmark, max(window, max_match + 1))
    free = (n for n in (f"_cleaned{i}" for i in range(len(docs.columns) + 2)) if n not in docs.columns)
    name = next(free)

    def renewed(rows: DataFrame, changed: Column, left: Column) -> DataFrame:
        new = {text_col: F.when(changed, left).otherwise(F.col(text_col))}
        if chars_col:
            new[chars_col] = F.when(changed, F.length(left).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col))
        return rows.withColumns(new)

    if blocks.count == 1:
        out = docs.withColumn(name, cleaner(blocks.load(0), window, max_match, max_coverage)(F.col(text_col).cast("string"))) \
            .filter(~F.col(f"{name}.dropped"))
        return renewed(out, F.col(f"{name}.changed"), F.col(f"{name}.text")).drop(name)
    numbered = docs.withColumn(name, F.monotonically_increasing_id())
    texts = numbered.select(F.col(name).alias("uid"), F.col(text_col).cast("string").alias("text"))
    hits = _hits(texts, blocks, window)
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda acc, x: acc + x)
    over = hit > F.lit(float(max_coverage)) * F.col("n_words")
    dropped, hits = hits.filter(over).select("uid"), hits.filter(~over)
    rounds: list[DataFrame] = []
    while True:
        held = materialise(texts.join(broadcast_if_small(hits.select("uid"), SMALL), "uid").join(hits, "uid"), "hit")
        texts = materialise(_cut(held, blocks, window, max_match), "cut")
        if texts.isEmpty():
            break
        rounds.append(texts.withColumn("round", F.lit(len(rounds))))
        hits = _hits(texts, blocks, window)
    if not rounds:
        return numbered.join(broadcast_if_small(dropped.withColumnRenamed("uid", name), SMALL), name, "left_anti").drop(name)
    text = next(free)
    last = materialise(_union(rounds).groupBy(F.col("uid").alias(name)).agg(F.max_by("text", "round").alias(text)), "last")
    gone = dropped.withColumnRenamed("uid", name).unionByName(last.select(name))
    # Only the rows that changed meet their texts; the others just pass by the numbers.
    kept = numbered.join(broadcast_if_small(gone, SMALL), name, "left_anti")
    cut = numbered.join(broadcast_if_small(last.select(name), SMALL), name, "left_semi").join(last, name)
    return kept.unionByName(renewed(cut, F.lit(True), F.col(text)).drop(text)).drop(name).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0),
                      lambda acc, x: acc + x).cast("long")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def oracle() -> str:
    words = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
    return f"""
with d as (select row_number() over () as rid, doc_id, {words} as w from documents),
b as (select item_id::varchar as item, {words} as w from benchmark),
windows as (select distinct item, m, array_to_string(w[p + 1 : p + m], ' ') as g from (
   select item, w, least(len(w), {WINDOW}) as m, unnest(range(len(w) - least(len(w), {WINDOW}) + 1)) as p from b
   where len(w) > 0)),
grams as (select rid, m, p, array_to_string(w[p + 1 : p + m], ' ') as g from (
   select rid, w, m, unnest(range(len(w) - m + 1)) as p from d, (select distinct m from windows) where len(w) >= m)),
hits as (select rid, p, m, item from grams join windows using (m, g)),
n as (select rid, count(distinct k) as n_hit from (select rid, unnest(range(p, p + m)) as k from hits) group by rid),
i as (select rid, list_sort(list(distinct item)) as items from hits group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (rid) left join i using (rid)"""
