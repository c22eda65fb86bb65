"""License scan by a positional rare-token index (DataFrame expressions only).

Every template is a word sequence with a *mandatory key phrase* inside it. The index holds
postings (template, position) of the words of the key phrases, and every word's IDF over the corpus.

Per file: the words of the index that occur in it say which templates it can hold (those whose
key phrase has all its words there). Of each of these, the file's ``LOOKUPS`` highest-IDF
words are looked up; a posting at template position q and a place p of the word in the file put the template
on the diagonal p - q. Intersecting the diagonals of the words leaves the starts where they
stand at their relative positions, and there the key phrase must stand complete. The template counts as found
when its words in place hold at least ``MIN_SHARE`` of its IDF weight. A start of the key phrase lies on
the diagonal of each of its words, so no place can be missed.

The only shuffle is the document-frequency count of the template vocabulary (a few hundred words,
combined map-side); the scan itself is one narrow projection.

Defined results: null text counts as empty (0 words, no place, empty labels,
score 0); repeated rows are scanned each on its own; a template overlapping
itself counts at every start; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, text_rows

MIN_SHARE = 0.8
LOOKUPS = 3  # of a template's words in a file


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key(self) -> list[str]:
        return self.mandatory.split()

    @property
    def key_at(self) -> int:
        w, k = self.words, self.key
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)


def _phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, text, base)


# The four base phrases and labels of the contract, then the method's own
# labels: version phrases and the operative sentences of common licences.
TEMPLATES = [
    _phrase("gpl", "gnu general public license", True),
    _phrase("apache", "apache license", True),
    _phrase("cc-by", "cc by", True),
    _phrase("mit", "mit license", True),
    _phrase("gpl-3.0", "gnu general public license version 3"),
    _phrase("gpl-2.0", "gnu general public license version 2"),
    _phrase("apache-2.0", "apache license version 2 0"),
    _phrase("cc-by-nc", "cc by nc"),
    _phrase("cc-by-sa", "cc by sa"),
    _phrase("cc-by-nd", "cc by nd"),
    _phrase("cc0", "cc0 1 0 universal"),
    _phrase("lgpl", "gnu lesser general public license"),
    _phrase("agpl", "gnu affero general public license"),
    _phrase("mpl", "mozilla public license"),
    _phrase("epl", "eclipse public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"
             " and associated documentation files the software to deal in the software without restriction",
             "permission is hereby granted free of charge"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted"
             " provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without"
             " fee is hereby granted", "permission to use copy modify and or distribute"),
    Template("apache-text", "you may not use this file except in compliance with the license you may obtain a copy of"
             " the license at", "except in compliance with the license"),
    Template("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of the"
             " gnu general public license as published by the free software foundation",
             "you can redistribute it and or modify it under the terms"),
    Template("mpl-text", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "source code form is subject to the terms"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "unencumbered software released into the public domain"),
    # Whole notices.
    Template("mit-notice", """permission is hereby granted free of charge to any person obtaining a copy of this software and
             associated documentation files the software to deal in the software without restriction including without
             limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and
             to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright
             notice and this permission notice shall be included in all copies or substantial portions of the software the
             software is provided as is without warranty of any kind express or implied including but not limited to the
             warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or
             copyright holders be liable for any claim damages or other liability whether in an action of contract tort or
             otherwise arising from out of or in connection with the software or the use or other dealings in the software""",
             "subject to the following conditions the above copyright notice and this permission notice shall be included"),
    Template("bsd-3-notice", """redistribution and use in source and binary forms with or without modification are permitted provided
             that the following conditions are met 1 redistributions of source code must retain the above copyright notice this
             list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright
             notice this list of conditions and the following disclaimer in the documentation and or other materials provided
             with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to
             endorse or promote products derived from this software without specific prior written permission""",
             "redistributions of source code must retain the above copyright notice"),
    Template("isc-notice", """permission to use copy modify and or distribute this software for any purpose with or without fee is
             hereby granted provided that the above copyright notice and this permission notice appear in all copies the software
             is provided as is and the author disclaims all warranties with regard to this software including all implied
             warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or
             consequential damages or any damages whatsoever resulting from loss of use data or profits""",
             "provided that the above copyright notice and this permission notice appear in all copies"),
    Template("apache-2.0-notice", """licensed under the apache license version 2 0 the license you may not use this file except in
             compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless
             required by applicable law or agreed to in writing software distributed under the license is distributed on an as is
             basis without warranties or conditions of any kind either express or implied see the license for the specific
             language governing permissions and limitations under the license""",
             "distributed under the license is distributed on an as is basis"),
    Template("gpl-notice", """this program is free software you can redistribute it and or modify it under the terms of the gnu general
             public license as published by the free software foundation either version 3 of the license or at your option any
             later version this program is distributed in the hope that it will be useful but without any warranty without even
             the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for
             more details you should have received a copy of the gnu general public license along with this program if not see""",
             "distributed in the hope that it will be useful but without any warranty"),
]


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def word_weights(words: DataFrame, vocab: list[str]) -> dict[str, int]:
    """Integer IDF weights of the vocabulary over all rows; at most one row per
    vocabulary word (and one for the row count) reaches the driver."""
    known = F.array_intersect(F.col("words"), F.array(*[F.lit(w) for w in vocab]))
    counts = {r["word"]: r["n"] for r in
              words.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("word")).groupBy("word")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = counts.get("", 0)  # each row counts the empty word once
    return {w: int(math.floor(1000 * math.log((rows + 1) / (counts.get(w, 0) + 1)))) + 1 for w in vocab}


def _words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rare_words(t: Template, weights: dict[str, int]) -> list[str]:
    """The highest-IDF words of a template's key phrase. (A file that can hold the template has all of them.)"""
    return sorted(set(t.key), key=lambda w: (-weights[w], w))[:LOOKUPS]


def _all_in(wanted: list[str], column: str) -> Column:
    found = F.lit(True)
    for w in wanted:
        found = found & F.array_contains(column, w)
    return found


def _starts(t: Template, weights: dict[str, int]) -> Column:
    """array<int>: where the key phrase of ``t`` stands complete; ``places`` are those of all looked-up words."""
    diagonals = None
    for word in rare_words(t, weights):
        here = F.filter("places", lambda p: F.get(F.col("words"), p) == word)
        postings = [q for q, w in enumerate(t.key) if w == word]
        d = F.flatten(F.array(*[F.transform(here, lambda p: p - q) for q in postings])) if len(postings) > 1 \
            else F.transform(here, lambda p: p - postings[0])
        diagonals = F.array_distinct(d) if diagonals is None else F.array_intersect(diagonals, d)
    key = _words(t.key)
    return F.filter(diagonals, lambda d: (d >= 0) & (F.slice(F.col("words"), F.greatest(d, F.lit(0)) + 1, len(t.key)) == key))


def _aligned(t: Template, weights: dict[str, int]) -> Column:
    """array<struct<label, start, share, base>> of the places of ``t``."""
    w, at = t.words, t.key_at
    total = sum(weights[x] for x in w)
    words, shares = _words(w), F.array(*[F.lit(weights[x]) for x in w])

    def share(s: Column) -> Column:
        if w == t.key:
            return F.lit(1.0)
        in_place = F.aggregate(F.sequence(F.lit(0), F.lit(len(w) - 1)), F.lit(0), lambda acc, j: acc + F.when(
            F.get(F.col("words"), s - at + j) == F.get(words, j), F.get(shares, j)).otherwise(0))
        return in_place.cast("double") / F.lit(float(total))

    return F.transform(_starts(t, weights), lambda s: F.struct(
        F.lit(t.label).alias("label"), (s - at).cast("long").alias("start"), share(s).alias("share"), F.lit(t.base).alias("base")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[Template] | None = None, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: the places found (``places``: label, start, share,
    base) and their summary columns."""
    templates = TEMPLATES if templates is None else templates
    words = text_rows(docs, id_col, text_col).select("doc_id", alnum_words(F.col("text")).alias("words"))
    weights = word_weights(words, vocabulary(templates))
    looked_up = {t.label: rare_words(t, weights) for t in templates}
    # Which of the looked-up words the file has at all, then their places: nothing is made of other words.
    every = sorted({w for ws in looked_up.values() for w in ws})
    seen = words.withColumn("present", F.array_intersect("words", _words(every)))
    places = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(every), i)))
    seen = seen.withColumn("places", F.when(F.size("present") > 0, places).otherwise(F.array().cast("array<int>")))
    typ = "array<struct<label:string,start:bigint,share:double,base:boolean>>"
    none = F.array().cast(typ)
    found = F.flatten(F.array(*[F.when(_all_in(looked_up[t.label], "present"), _aligned(t, weights)).otherwise(none) for t in templates]))
    # Most files have none of the words: they skip the templates.
    out = seen.select("doc_id", F.size("words").cast("long").alias("n_words"),
                      F.when(F.size("present") > 0, found).otherwise(none).alias("aligned"))
    base = F.filter("aligned", lambda p: p["base"])
    kept = F.filter("aligned", lambda p: p["share"] >= min_share)
    names = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(a, lambda p: p["label"]))))
    starts = F.transform(base, lambda p: p["start"])
    return out.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform("aligned", lambda p: p["share"])), F.lit(0.0)).alias("score"),
        kept.alias("places"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    from .common import prepare, table
    return scan_licenses(table(prepare(spark), sf_dir, "documents")).drop("places")


def oracle() -> str:
    """DuckDB: every start of every key phrase, by brute force over word lists."""
    quote = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    rows = ",\n".join(f"({i}, '{t.label}', {quote(t.words)}, {quote(t.key)}, {t.key_at}, {t.base})"
                      for i, t in enumerate(TEMPLATES))
    vocab = ", ".join(f"('{w}')" for w in vocabulary(TEMPLATES))
    return rf"""
with templates(tid, label, ws, ks, off, base) as (values {rows}),
vocab(word) as (values {vocab}),
d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
df as (select word, count(*) as n from (select unnest(list_distinct(w)) as word from d) group by word),
idf as (select v.word, floor(1000 * ln(((select count(*) from d) + 1) / (coalesce(df.n, 0) + 1)))::bigint + 1 as wt
        from vocab v left join df using (word)),
total as (select tid, sum(wt) as total from (select tid, unnest(ws) as word from templates) join idf using (word)
          group by tid),
cand as (select rid, w, t.*, unnest(list_filter(range(len(w)::bigint), lambda i: w[i + 1] = ks[1]
           and w[i + 1 : i + len(ks)] = ks)) as kp
         from d, templates t where list_has_all(w, ks)),
wordwise as (select rid, tid, kp, kp - off as start, unnest(ws) as word, generate_subscripts(ws, 1) as j, w from cand),
place as (select rid, tid, start, sum(case when start + j >= 1 and w[start + j] = word then wt else 0 end) as got
          from wordwise join idf using (word) group by rid, tid, kp, start),
p as (select rid, label, base, start, got::double / total::double as share
      from place join templates using (tid) join total using (tid)),
s as (select rid, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word,
        max(start) filter (where base) as last_word,
        array_to_string(list_sort(list(distinct label) filter (where base)), ',') as base_labels,
        array_to_string(list_sort(list(distinct label) filter (where share >= {MIN_SHARE})), ',') as labels,
        max(share) as score from p group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0.0)::double as score
from d left join s using (rid)"""
