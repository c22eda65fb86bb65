"""Periodic run detection with a suffix automaton and link-cut access.

A run is a maximal stretch of consecutive words with a smallest period q (words q
apart are identical) that is long enough: ``length >= max(min_length, min_exponent * q)``.

Method, per text: the states of the words' suffix automaton form a tree by their
suffix links, held as a link-cut forest of splayed paths. Each path carries one
colour, the end of the last prefix that passed through it. Appending word i
accesses the path from prefix i to the root, which falls into segments of one
colour e each: every suffix of up to the segment's length L (that of its deepest
state) occurred last with its end at e. If the distance d = i - e is within L, a
square of period d ends at i, and the stretch of period d that ends there is the
last L + d words. It is a run of smallest period d once the next word does not
continue it. The path is then recoloured with i; an access costs an amortised
logarithm of the text's length.

Most words of natural text can't lie in a run. In a run of period q all grams
after the first q words were seen at most q words before, so a text is first cut
to the stretches where that holds (``stretches``); only those enter the automaton.
They contain every run with a word on both sides, so nothing is missed.

Words are the maximal runs of characters other than ASCII white space. Defined
results: a null or empty text has no words, no runs and an empty collapsed text;
texts are whole, memory grows with the longest stretch of a single text (about
0.2 kB a word); repeated rows are answered each; empty tables give no rows; other
columns are ignored, so their names can't clash.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, prepare, split_words, table, text_rows
from .workers import tidy

MIN_LENGTH = 6
MIN_EXPONENT = 4
GRAM = 4  # words of the grams that choose the stretches, fewer where runs may be shorter
LONG = 1 << 20  # states of a stretch that is held in arrays
ROUNDS = 20  # of narrowing the stretches; the result does not depend on it

RUNS = "array<struct<start: long, length: long, period: long>>"


def _numbers(n: int, value: int = 0) -> list[int] | array:
    """``n`` numbers: a list, which is fast, or for long stretches an array, which is small."""
    return [value] * n if n < LONG else array("i", [value]) * n


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length) of every state and the state of every prefix.
    State 1 is the root; 0 stands for none."""
    n = 2 * len(words) + 2
    link, longest = _numbers(n), _numbers(n)
    # Most states have one transition, kept in two lists; the rest of a state's are in ``more``.
    word, target = _numbers(n), _numbers(n)
    more: dict[int, dict[int, int]] = {}
    prefixes = _numbers(len(words))
    last, count = 1, 2
    for i, w in enumerate(words):
        state = count
        count += 1
        longest[state] = longest[last] + 1
        p, q = last, 0
        while p:
            if not target[p]:
                word[p], target[p] = w, state
            elif word[p] == w:
                q = target[p]
                break
            else:
                others = more.setdefault(p, {})
                q = others.get(w, 0)
                if q:
                    break
                others[w] = state
            p = link[p]
        if not q:
            link[state] = 1
        elif longest[q] == longest[p] + 1:
            link[state] = q
        else:
            copy = count
            count += 1
            longest[copy] = longest[p] + 1
            word[copy], target[copy], link[copy] = word[q], target[q], link[q]
            if q in more:
                more[copy] = dict(more[q])
            while p:
                if word[p] == w and target[p] == q:
                    target[p] = copy
                elif p in more and more[p].get(w) == q:
                    more[p][w] = copy
                else:
                    break
                p = link[p]
            link[q] = link[state] = copy
        prefixes[i] = last = state
    return link, longest, prefixes


def runs_of(words: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of words, by start, then period. ``min_exponent >= 2``."""
    link, longest, prefixes = suffix_automaton(words)
    n = len(words)
    up = link  # of a path's topmost splay node: the state above the path
    left, right = _numbers(len(up)), _numbers(len(up))
    colour = _numbers(len(up), -1)  # valid at the root of a splay tree

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            colour[x] = colour[p]

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[p] == x) == (left[g] == p) else x)
            rotate(x)

    found = []
    for i, prefix in enumerate(prefixes):
        x, below = prefix, 0
        while x:
            splay(x)
            # From here up to the top of its path all states were last passed by the prefix that ends at ``e``.
            e = colour[x]
            if right[x]:
                colour[right[x]] = e  # what lies below keeps its colour as a path of its own
            right[x] = below
            if e >= 0:
                d, size = i - e, longest[x]
                if size + d >= min_length and size + d >= min_exponent * d and (i + 1 == n or words[i + 1] != words[i + 1 - d]):
                    found.append((i + 1 - d - size, size + d, d))
            below, x = x, up[x]
        colour[below] = i
        splay(prefix)
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def gram_keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A number for every gram of ``n`` words, equal where the grams are."""
    most = int(ids.max()) + 1
    keys = ids
    for k in range(1, n):
        if int(keys.max()) >= (1 << 62) // most:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys[:-1] * most + ids[k:]
    return keys


def stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Disjoint word ranges that hold every run together with its neighbouring words.

    A run of period q and length m has m - q - gram + 1 grams in a row that were seen at
    most q words before. So in c such grams in a row q is at most (c + gram - 1) / (exponent - 1)."""
    least = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    gram = max(1, min(GRAM, least))
    if len(ids) < min_length or len(ids) < gram:
        return []
    keys = gram_keys(ids, gram)
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]]) + 1
    distance = np.full(len(keys), len(ids))
    distance[order[again]] = order[again] - order[again - 1]
    kept = distance < len(ids)
    first, behind, longest = np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    for _ in range(ROUNDS):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
        first, behind = edges[::2], edges[1::2]
        size = behind - first
        enough = size >= least - gram + 1
        first, behind, size = first[enough], behind[enough], size[enough]
        if not len(first):
            return []
        longest = (size + gram - 1) // (min_exponent - 1)
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        near = np.zeros(len(kept), dtype=bool)
        near[at] = distance[at] <= np.repeat(longest, size)
        if np.array_equal(near, kept):
            break
        kept = near
    out: list[tuple[int, int]] = []
    for a, b in zip(np.maximum(first - longest - 1, 0).tolist(), np.minimum(behind + gram, len(ids)).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (min(out[-1][0], a), max(out[-1][1], b))
            while len(out) > 1 and out[-1][0] <= out[-2][1]:
                a, b = out.pop()
                out[-1] = (min(out[-1][0], a), max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def text_runs(words: list[bytes], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """The runs of a text's words."""
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, len(seen)) for w in words]
    if len(seen) == len(ids):
        return []
    out = []
    for a, b in stretches(np.array(ids, dtype=np.int64), min_length, min_exponent):
        out += [(a + start, length, period) for start, length, period in runs_of(ids[a:b], min_length, min_exponent)]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def detector(min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """UDF: the words, runs and collapsed text of a text column."""

    @F.pandas_udf(f"n_words long, runs {RUNS}, collapsed string")
    @tidy
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            counts, found, short = [], [], []
            for text in texts:
                words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
                runs = text_runs(words, min_length, min_exponent)
                counts.append(len(words))
                found.append([{"start": s, "length": m, "period": p} for s, m, p in runs])
                short.append(b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"n_words": np.array(counts, dtype=np.int64), "runs": pd.Series(found, dtype=object),
                                "collapsed": pd.Series(short, dtype=object)})

    return detect


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (by start, then period) and the text without repeats."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two words and two periods")
    detect = detector(min_length, min_exponent)
    return text_rows(docs, id_col, text_col).select("doc_id", detect("text").alias("found")).select("doc_id", "found.*")


def periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: the contract's texts. Where h = crc32(doc_id) ends in 0, the words from ``a`` on
    repeat with period ``p`` (words joined by one space); other texts are as they are."""
    rows = text_rows(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    rows = rows.withColumn("w", F.when(F.expr("h % 10 = 0"), split_words(F.col("text"), WHITESPACE)))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = F.expr("slice(w, a + 1, p)")
    times = F.expr("cast((n - a) div p + 1 as int)")
    repeated = F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), F.expr("n - a"))
    whole = F.array_join(F.concat(F.expr("slice(w, 1, a)"), repeated), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, whole).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs``' rows."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                              r["period"].cast("string")), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                              r["period"].alias("period"))))
    rows = found.withColumn("best", best)

    def of_best(value: str) -> Column:
        return F.expr(f"cast({value} as long)")

    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        of_best("-best.less").alias("length"), F.col("best.period").alias("period"),
        of_best("(-1000 * best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return digests(periodic_runs(periodic_tails(docs)))


def oracle() -> str:
    """Runs as islands of equal 3-grams at one distance; those of a multiple of another's period on the same words go."""
    return r"""
with numbered as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
split as (
  select rid, doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
      lambda h, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::bigint[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(h, b)),
      4294967295::bigint), 4294967295::bigint) as h
  from numbered),
planted as (select rid, doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as hit, h // 10 as g,
    case when len(w) > 0 then (h // 10) % len(w) else 0 end as a from split),
texts as (
  select rid, doc_id, n, case when hit then list_transform(range(n), lambda i:
      w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) else w end as w
  from planted),
words as (select rid, n, unnest(w) as word, unnest(range(n)) as i from texts),
coded as (select rid, n, i, word, dense_rank() over (order by word) as code from words),
grams as (
  select rid, n, i, code as a, lead(code) over o as b, lead(code, 2) over o as c
  from coded window o as (partition by rid order by i)),
pairs as (
  select y.rid, y.i, y.i - x.i as period
  from grams y join grams x on x.rid = y.rid and x.a = y.a and x.b = y.b and x.c = y.c
  where x.i < y.i and 4 * (y.i - x.i) <= y.n),
islands as (select rid, period, i, i - row_number() over (partition by rid, period order by i) as island from pairs),
periodic as (
  select rid, min(i) - period as start, count(*) + 2 + period as length, period
  from islands group by rid, period, island
  having count(*) + 2 + period >= greatest(6, 4 * period)),
runs as (select rid, start, length, min(period) as period from periodic group by rid, start, length),
per_text as (
  select rid, count(*) as n_runs, min((-length, start, period)) as best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by rid),
dropped as (select distinct rid, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select rid, string_agg(word, ' ' order by i) as text
  from words anti join dropped using (rid, i) group by rid)
select t.doc_id, coalesce(n_runs, 0) as n_runs, best[2]::bigint as start, -best[1]::bigint as length,
  best[3]::bigint as period, (-1000 * best[1]) // best[3] as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from texts t left join per_text using (rid) left join kept k using (rid)"""
