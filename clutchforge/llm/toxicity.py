"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features (per text, over words of letters and digits, lower-cased): densities
of a fixed lexicon and of a lexicon (words and word beginnings) learned from the
training labels, their counts and numbers of distinct words, lexicon words near the second person,
second-person density, shares of capitals, of words in capitals, of punctuation
and exclamation marks, obfuscated lexicon words (digits or signs for letters),
text length. Trees and calibration are fitted on at most ``MAX_TRAIN_ROWS``
labelled rows; a fifth of them is kept for the calibration only.

Defined results: null text counts as empty, an empty text has all features 0;
without both labels every score is the training share of label 1 (0 without
rows); repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit
from .common import alnum_words, materialise, prepare, table, text_rows
from .labelled import fold, training_rows

MAX_TRAIN_ROWS = 16384
THRESHOLD = 0.7
LEARNED_WORDS = 256  # and as many beginnings
STEM_BYTES = 5
NEAR = 4  # words
# Insults and abuse that toxic texts use.
LEXICON = ("idiot idiots moron morons stupid dumb dumbass loser losers pathetic scum worthless disgusting clown trash "
           "garbage jerk fool fools imbecile cretin bastard bitch whore slut asshole fuck fucking shit bullshit crap damn "
           "hate kill die ugly freak creep pig vermin filth filthy retard retarded hell suck sucks shut").split()
# The second person in the languages of the tables.
SECOND_PERSON = ("you your yours yourself u ur ya du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
                 "tú ti tuyo usted ustedes vosotros vuestro").split()
# Signs that stand for letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
NAMES = ["lexicon_density", "lexicon_count", "lexicon_kinds", "learned_density", "learned_count", "learned_kinds",
         "near_you", "you_density", "capitals", "capital_words", "punctuation", "exclamations", "obfuscated", "log_words"]

_UNSIGN = textkit.LOWER.copy()
for _k, _v in SIGNS.items():
    _UNSIGN[ord(_k)] = ord(_v)
_SIGNED = textkit.ALNUM.copy()
for _k in SIGNS:
    _SIGNED[ord(_k)] = True


def word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(textkit.words(words, textkit.ALNUM).hashes) if words else np.zeros(0, dtype=np.uint64)


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), dtype=bool)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h


def _stems(w: textkit.Words) -> np.ndarray:
    """Hashes of the words' first STEM_BYTES bytes; 0 for words that are no longer."""
    long = w.ends - w.starts > STEM_BYTES
    out = np.zeros(len(w.hashes), dtype=np.uint64)
    out[long] = textkit.hash_slices(w.buffer, w.starts[long], w.starts[long] + STEM_BYTES)
    return out


def features(texts: list[str], learned: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """A row of NAMES per text; ``learned`` words and ``stems`` as sorted hashes."""
    lexicon, you = word_hashes(LEXICON), word_hashes(SECOND_PERSON)
    buffer, at = textkit.layout(texts)
    w = textkit.cut(textkit.LOWER[buffer], at, textkit.ALNUM)
    signed = textkit.cut(_UNSIGN[buffer], at, _SIGNED)  # words whose signs are read as letters
    n = np.maximum(w.counts, 1).astype(float)
    chars = np.maximum(np.diff(at) - 1, 1).astype(float)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)

    def kinds(flags: np.ndarray) -> np.ndarray:
        text = np.repeat(np.arange(len(texts)), w.counts)[flags]
        pairs = np.unique(np.stack([text.astype(np.uint64), w.hashes[flags]]), axis=1)[0].astype(int)
        return np.bincount(pairs, minlength=len(texts)).astype(float)

    bad, second = _among(w.hashes, lexicon), _among(w.hashes, you)
    taught = _among(w.hashes, learned) | _among(_stems(w), stems)
    text_of = np.repeat(np.arange(len(texts)), w.counts)
    near = np.zeros(len(bad), dtype=bool)
    for k in range(1, NEAR + 1):
        same = text_of[k:] == text_of[:-k]
        near[k:] |= second[:-k] & same
        near[:-k] |= second[k:] & same
    upper = (buffer >= 65) & (buffer <= 90)
    letters = upper | ((buffer >= 97) & (buffer <= 122))
    ups, lets = np.concatenate([[0], np.cumsum(upper)]), np.concatenate([[0], np.cumsum(letters)])
    shout = (w.ends - w.starts >= 2) & (ups[w.ends] - ups[w.starts] == w.ends - w.starts)
    signs = ~textkit.ALNUM[textkit.LOWER[buffer]] & textkit.NOT_SPACE[buffer]
    capital = per_text(upper, at) / np.maximum(per_text(letters, at), 1)
    either = bad | taught
    hidden = np.maximum(per_text(_among(signed.hashes, lexicon) | _among(signed.hashes, learned), signed.bounds)
                        - per_text(bad | _among(w.hashes, learned), w.bounds), 0)
    cols = [per_text(bad, w.bounds) / n, per_text(bad, w.bounds), kinds(bad),
            per_text(taught, w.bounds) / n, per_text(taught, w.bounds), kinds(taught),
            per_text(either & near, w.bounds) / n, per_text(second, w.bounds) / n, capital,
            per_text(shout, w.bounds) / n, per_text(signs, at) / chars, per_text(buffer == 33, at) / chars,
            hidden / n, np.log1p(w.counts)]
    return np.stack(cols, axis=1)


def learn_lexicon(rows: DataFrame, size: int = LEARNED_WORDS) -> tuple[list[str], list[bytes]]:
    """The words, and the beginnings of words, in the training rows that speak
    most for label 1 (document counts, smoothed log odds over 3, at least 4
    documents with label 1)."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return [], []
    words = F.transform(alnum_words(F.col("text")), lambda w: F.encode(w, "UTF-8"))
    found = materialise(rows.select("label", F.array_distinct(words).alias("words")), "words")
    stems = F.array_distinct(F.transform(F.filter("words", lambda w: F.octet_length(w) > STEM_BYTES),
                                         lambda w: F.substring(w, 1, STEM_BYTES)))
    odds = F.log((F.col("toxic") + 0.5) / (totals[1] + 1)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (totals[0] + 1))

    def telling(entries) -> list[bytes]:
        counts = found.select("label", F.explode(entries).alias("entry")).groupBy("entry") \
            .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).filter("toxic >= 4")
        top = counts.withColumn("odds", odds).filter("odds > 3").orderBy(F.desc(F.col("odds") * F.col("toxic")), "entry")
        return sorted(bytes(r["entry"]) for r in top.limit(size).collect())

    return [w.decode() for w in telling(F.col("words"))], telling(stems)


def feature_column(lexicon: tuple[list[str], list[bytes]]) -> Callable[[Column], Column]:
    """The features of a text column, as an array; ``lexicon`` as learned."""
    known, stems = word_hashes(lexicon[0]), np.zeros(0, dtype=np.uint64)
    if lexicon[1]:
        joined = np.frombuffer(b"".join(lexicon[1]), dtype=np.uint8)
        at = np.arange(0, len(joined), STEM_BYTES)
        stems = np.sort(textkit.hash_slices(joined, at, at + STEM_BYTES))

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        found = [features(part, known, stems) for _, part in textkit.pieces(texts.tolist(), 1 << 20)]
        return pd.Series(list(np.concatenate(found)) if found else [], dtype=object)

    return described


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1,
                   max_rows: int = MAX_TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    train = materialise(training_rows(docs, labels, "toxic", folds, held_out, max_rows), "train")
    described = feature_column(learn_lexicon(train))
    train = materialise(train.select("doc_id", "label", described("text").alias("features"))
                        .withColumn("features", array_to_vector("features"))
                        .withColumn("part", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(5)))
                        .withColumn("label", F.col("label").cast("double")), "features")
    fit, held = train.filter("part <> 0").coalesce(4), train.filter("part = 0")
    found = {r["label"] for r in fit.select("label").distinct().collect()}
    slim = text_rows(docs)
    if found != {0.0, 1.0}:
        share = train.agg(F.avg("label")).first()[0] or 0.0
        scored = slim.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3,
                              maxBins=32, seed=5).fit(fit)
        margin = F.element_at(vector_to_array("probability"), 2)
        calibrate = held if held.filter("label = 1").limit(1).count() else fit
        iso = IsotonicRegression(featuresCol="raw", labelCol="label").fit(
            trees.transform(calibrate).select("label", margin.alias("raw")))
        all_ = slim.select("doc_id", described("text").alias("features")) \
            .withColumn("features", array_to_vector("features"))
        raw = trees.transform(all_).select("doc_id", margin.alias("raw"))
        # Isotonic steps tie many scores; a trace of the raw score keeps their order inside a step.
        scored = iso.transform(raw).select("doc_id", F.least(F.lit(1.0), F.greatest(
            F.lit(0.0), F.col("prediction") * 0.99 + F.col("raw") * 0.01)).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
