"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text: uni- and bigrams of its lower-cased words and of its word
shapes (letters to x / X, digits to 9, repeats collapsed: "THEY!!" is "X!"), hashed into
``2**BITS`` places, each as its share of the text's n-grams of that kind. A
score is a sparse dot product. Training uses at most ``MAX_TRAIN_ROWS`` labelled
rows in shards of ``SHARD_ROWS``, one task each, which streams its rows; the shards'
weights are averaged. Texts are hashed about ``PIECE`` characters at a time.

Defined results: null text counts as empty; an empty text has no n-grams, its
score is that of the bias; without labels every score is 0.5; repeated rows are
scored each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import materialise, prepare, table, text_rows
from .labelled import fold, training_rows
from .workers import tidy

BITS = 18
MAX_TRAIN_ROWS = 16384
SHARD_ROWS = 4096
EPOCHS = 3
THRESHOLD = 0.7
SCALE = 8.0  # of a text's shares, so that steps are of a useful size
PIECE = 1 << 18  # characters that are hashed at once
SPACES = " \t\n\v\f\r"

_SHAPE = textkit._bytes.astype(np.uint8)
_SHAPE[65:91] = ord("X")
_SHAPE[97:123] = ord("x")
_SHAPE[48:58] = ord("9")
_SHAPE[128:] = ord("x")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values and text numbers (ascending) of a batch; a place may repeat in a text."""
    places, values, rows = [], [], []
    for kind, (w, n) in enumerate(_kinds(texts)):
        h, bounds = textkit.grams(w, n)
        count = np.diff(bounds)
        places.append(_place(h, kind))
        row = np.repeat(np.arange(len(texts)), count)
        rows.append(row)
        values.append((SCALE / np.sqrt(np.maximum(count, 1)) / np.sqrt(np.maximum(count, 1)))[row])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return np.concatenate(places)[order], np.concatenate(values)[order], row[order]


def _kinds(texts: list[str]) -> list[tuple[textkit.Words, int]]:
    """Words and word shapes, each for grams of one and of two; the same number of both."""
    buffer, at = textkit.layout(texts)
    plain = textkit.cut(textkit.LOWER[buffer], at, textkit.NOT_SPACE)
    shaped = _SHAPE[buffer]
    keep = np.concatenate([[True], shaped[1:] != shaped[:-1]])
    keep[np.maximum(at[1:] - 1, 0)] = True  # the separator after each text
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    shapes = textkit.cut(shaped[keep], kept_before[at], textkit.NOT_SPACE)
    return [(plain, 1), (plain, 2), (shapes, 1), (shapes, 2)]


def _place(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (textkit.mix(hashes + np.uint64(kind + 1)) >> np.uint64(64 - BITS)).astype(np.int64)


def long_features(text: str, limit: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of one very long text, a stretch of about ``limit`` characters at a time:
    memory is that of the counts, whatever the length. A stretch starts with the
    word that the last one ended with, for the grams across the cut."""
    counts = np.zeros((4, 1 << BITS))
    totals = np.zeros(4)
    at, last = 0, ""
    while at < len(text):
        end = min(len(text), at + limit)
        while end < len(text) and text[end] not in SPACES:
            end += 1
        stretch = f"{last} {text[at:end]}" if last else text[at:end]
        for kind, (w, n) in enumerate(_kinds([stretch])):
            h = textkit.grams(w, n)[0]
            if n == 1 and last:
                h = h[1:]  # counted before
            counts[kind] += np.bincount(_place(h, kind), minlength=1 << BITS)
            totals[kind] += len(h)
        found = stretch.strip(SPACES)
        last = found[max(found.rfind(c) for c in SPACES) + 1:]
        at = end
    kinds, places = np.nonzero(counts)
    return places, counts[kinds, places] * SCALE / totals[kinds]


def sparse(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, values and text numbers of texts (null: empty), some texts at a time."""
    for first, part in textkit.pieces(texts, PIECE):
        place, value, row = features(["" if len(t) > PIECE else t for t in part])
        yield place, value, row + first
        for i, text in enumerate(part):
            if len(text) > PIECE:
                place, value = long_features(text)
                yield place, value, np.full(len(place), first + i)


class Ftrl:
    """Weights (bias last) under FTRL-proximal updates, row by row."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
        self.rows = 0

    def weights(self, i: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[i]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        i, back = np.unique(places, return_inverse=True)
        x = np.append(np.bincount(back, values, minlength=len(i)), 1.0)
        i = np.append(i, 1 << BITS)
        w, n = self.weights(i), self.n[i]
        p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w @ x)))))
        g = (p - label) * x
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[i] += g - step * w
        self.n[i] += g * g
        self.rows += 1

    def learn(self, texts: list[str], labels: list[int]) -> None:
        """Updates for texts in their order; an empty one moves the bias only."""
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for place, value, row in sparse(texts):
            cuts = np.searchsorted(row, np.arange(row[0], row[-1] + 2)) if len(row) else np.zeros(0, dtype=int)
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if b > a:
                    known[int(row[0]) + k] = place[a:b], value[a:b]
        none = np.zeros(0, dtype=np.int64), np.zeros(0)
        for t, label in enumerate(labels):
            self.update(*known.get(t, none), label)


def train(rows: DataFrame, epochs: int = EPOCHS) -> np.ndarray:
    """Shards are fitted by their own tasks, which read their rows in hash order, once per epoch, and
    hold a batch at a time; at most MAX_TRAIN_ROWS / SHARD_ROWS weight vectors come back."""
    total = rows.count()
    if not total:
        return np.zeros((1 << BITS) + 1)
    shards = math.ceil(total / SHARD_ROWS)

    @tidy
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, model = None, None

        def fitted() -> pd.DataFrame:
            return pd.DataFrame({"shard": [shard], "n": [model.rows], "weights": [model.weights().astype("<f4").tobytes()]})

        for pdf in batches:
            for number, part in pdf.groupby("shard", sort=False):
                if number != shard:
                    if model:
                        yield fitted()
                    shard, model = int(number), Ftrl()
                for first, texts in textkit.pieces(part["text"].tolist(), PIECE):
                    model.learn(texts, part["label"].tolist()[first:first + len(texts)])
        if model:
            yield fitted()

    ordered = rows.select(
        F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(shards)).cast("int").alias("shard"), F.xxhash64(F.lit(4), "doc_id").alias("order"),
        "doc_id", "text", "label", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    ordered = ordered.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "epoch", "order", "doc_id")
    fitted = ordered.select("shard", "text", "label").mapInPandas(fit, "shard int, n long, weights binary").collect()
    parts = sorted((r["shard"], r["n"], bytes(r["weights"])) for r in fitted)
    return np.average([np.frombuffer(w, "<f4") for _, _, w in parts], axis=0, weights=[n for _, n, _ in parts])


def scorer(spark: SparkSession, weights: np.ndarray) -> Callable[[Column], Column]:
    """The score of a text column under ``weights``."""
    shared = spark.sparkContext.broadcast(weights.astype("<f4"))  # 2**BITS + 1 floats

    @F.pandas_udf("double")
    @tidy
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value.astype(float)
        for series in texts:
            out = np.full(len(series), w[-1])
            for place, value, row in sparse(series.tolist()):
                out += np.bincount(row, w[place] * value, minlength=len(series))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))

    return score


def fitted_scorer(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
                  max_rows: int = MAX_TRAIN_ROWS) -> Callable[[Column], Column]:
    rows = training_rows(docs, labels, "quality", folds, held_out, max_rows)
    return scorer(docs.sparkSession, train(materialise(rows, "train")))


def classify_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
                     max_rows: int = MAX_TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    score = fitted_scorer(docs, labels, folds, held_out, max_rows)
    return text_rows(docs).select("doc_id", score("text").alias("score")).select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
