"""Upset model: time-ordered splits, features, boosted trees, threshold and metrics.

Everything is a Spark job. Splits place rows in global time order with the
skew-safe ``sequence_index``; threshold search and ROC-AUC use running sums
over the distinct scores (``sequence_index(sum_cols=...)``), so no step
collects the scored rows to the driver or into one task. The model is
``pyspark.ml``'s gradient-boosted trees.

For the SQL-comparable checks a deterministic score stands in for the model
(``delta / (delta + 50)``); the same functions run on real model output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import one_row
from ..operators.sequence import sequence_index
from ..sources.tables import Catalog
from . import marts

# Fixed values of the model.
FEATURE_COLUMNS = ["ranking_delta", "is_cross_region", "team_a_ranking", "team_b_ranking"]
BOOLEAN_FEATURE_COLUMNS = ["is_cross_region"]
TARGET_COLUMN = "is_upset"
DATE_COLUMN = "played_at"
DEFAULT_DECISION_THRESHOLD = 0.5
DECISION_THRESHOLD_BETA = 0.75
GBT_PARAMS = dict(maxIter=40, maxDepth=3, stepSize=0.08, subsamplingRate=0.9,
                  featureSubsetStrategy="0.9", seed=42)
CALIBRATION_BINS = 5
STAND_IN_SCALE = 50.0


def feature_frame(cat: Catalog) -> DataFrame:
    """Feature matrix: booleans null -> 0, other nulls -> -1; label as int."""
    u = marts.table(cat, "mart_upset_features")
    missing = [c for c in FEATURE_COLUMNS + [TARGET_COLUMN, DATE_COLUMN] if c not in u.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    feats = []
    for c in FEATURE_COLUMNS:
        if c in BOOLEAN_FEATURE_COLUMNS:
            feats.append(F.coalesce(F.col(c).cast("boolean").cast("int"), F.lit(0)).cast("double").alias(c))
        else:
            feats.append(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c))
    return u.select("match_sk", DATE_COLUMN, *feats, F.col(TARGET_COLUMN).cast("int").alias("label"))


def _time_positions(df: DataFrame) -> DataFrame:
    """0-based position in (played_at, match_sk) order plus the row count."""
    placed = sequence_index(df, [], [F.col(DATE_COLUMN).asc_nulls_last(), F.col("match_sk").asc()], out="_pos")
    n = one_row(df.agg(F.count(F.lit(1)).alias("_n")))
    return placed.crossJoin(n)


def temporal_split(df: DataFrame, test_fraction: float = 0.2) -> DataFrame:
    """Add ``split`` = train / test; the newest rows are the test part."""
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be between 0 and 1")
    p = _time_positions(df)
    idx = F.floor(F.col("_n") * F.lit(1 - test_fraction))
    idx = F.greatest(F.lit(1), F.least(idx, F.col("_n") - 1))
    return p.withColumn("split", F.when(F.col("_pos") < idx, F.lit("train")).otherwise(F.lit("test"))).drop("_pos", "_n")


def temporal_split3(df: DataFrame, validation_fraction: float = 0.2, test_fraction: float = 0.2) -> DataFrame:
    """Add ``split`` = train / validation / test in time order (each part >= 1 row)."""
    if not (0 < validation_fraction < 1 and 0 < test_fraction < 1 and validation_fraction + test_fraction < 1):
        raise ValueError("fractions must be in (0, 1) and sum below 1")
    p = _time_positions(df)
    n = F.col("_n")
    test = F.greatest(F.lit(1), F.floor(n * F.lit(test_fraction)))
    val = F.greatest(F.lit(1), F.floor(n * F.lit(validation_fraction)))
    crowded = (val + test) >= n
    val2 = F.when(crowded, F.greatest(F.lit(1), F.least(val, n - 2))).otherwise(val)
    test2 = F.when(crowded, F.greatest(F.lit(1), F.least(test, n - val2 - 1))).otherwise(test)
    p = p.withColumn("_val", val2).withColumn("_test", test2)
    train_end = n - F.col("_val") - F.col("_test")
    val_end = n - F.col("_test")
    split = (F.when(F.col("_pos") < train_end, F.lit("train"))
             .when(F.col("_pos") < val_end, F.lit("validation")).otherwise(F.lit("test")))
    return p.withColumn("split", split).drop("_pos", "_n", "_val", "_test")


def stand_in_score(df: DataFrame) -> DataFrame:
    d = F.col("ranking_delta")
    return df.withColumn("score", F.when(d >= 0, d / (d + F.lit(STAND_IN_SCALE))).otherwise(F.lit(0.0)))


def _per_score(scored: DataFrame, score: str) -> DataFrame:
    return scored.groupBy(F.col(score).alias("s")).agg(
        F.sum("label").cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))


def threshold_search(scored: DataFrame, score: str = "score", beta: float = DECISION_THRESHOLD_BETA,
                     max_positive_rate: F.Column | float | None = None) -> DataFrame:
    """Best F-beta threshold over all distinct scores (predict positive when
    score >= threshold), skipping thresholds whose predicted-positive rate is
    above the cap; ties go to the lowest threshold; one class or no candidate
    gives the default 0.5. Returns one row (threshold, fbeta, positive_rate)."""
    totals = one_row(scored.agg(F.count(F.lit(1)).alias("_N"), F.sum("label").cast("long").alias("_P")))
    per = _per_score(scored, score)
    run = sequence_index(per, [], [F.col("s").desc()], out="_i", sum_cols=("pos", "n"))
    c = run.crossJoin(totals)
    tp, pp = F.col("running_pos"), F.col("running_n")
    fn, fp = F.col("_P") - tp, pp - tp
    b2 = beta * beta
    fbeta = F.when(tp > 0, ((1 + b2) * tp) / ((1 + b2) * tp + b2 * fn + fp)).otherwise(F.lit(0.0))
    rate = pp / F.col("_N")
    cap = F.col("_P") / F.col("_N") if max_positive_rate is None else (
        max_positive_rate if isinstance(max_positive_rate, F.Column) else F.lit(max_positive_rate))
    cand = c.select(F.col("s").alias("threshold"), fbeta.alias("fbeta"), rate.alias("positive_rate"),
                    cap.alias("cap"), F.col("_P"), F.col("_N")).where(F.col("positive_rate") <= F.col("cap"))
    best = cand.agg(F.max_by(F.struct("threshold", "fbeta", "positive_rate"),
                             F.struct(F.col("fbeta"), -F.col("threshold"))).alias("b"))
    shape = one_row(totals).crossJoin(best)
    one_class = (F.col("_P") == 0) | (F.col("_P") == F.col("_N"))
    return shape.select(
        F.when(one_class | F.col("b").isNull(), F.lit(DEFAULT_DECISION_THRESHOLD))
        .otherwise(F.col("b.threshold")).alias("threshold"),
        F.when(one_class, F.lit(None).cast("double")).otherwise(F.col("b.fbeta")).alias("fbeta"),
        F.when(one_class, F.lit(None).cast("double")).otherwise(F.col("b.positive_rate")).alias("positive_rate"),
        (F.col("_P") / F.col("_N")).alias("cap"))


def roc_auc(scored: DataFrame, score: str = "score") -> DataFrame:
    """Rank-sum ROC-AUC with ties counted half; 0.5 for one class. Exact:
    integer running sums over the distinct scores, one division."""
    per = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum("label").cast("long").alias("pos"), (F.count(F.lit(1)) - F.sum("label")).cast("long").alias("neg"))
    run = sequence_index(per, [], [F.col("s").asc()], out="_i", sum_cols=("neg",))
    below = F.col("running_neg") - F.col("neg")
    agg = run.agg(F.sum(F.col("pos") * (2 * below + F.col("neg"))).alias("_num"),
                  F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    return agg.select(F.when((F.col("_p") == 0) | (F.col("_q") == 0), F.lit(0.5))
                      .otherwise(F.col("_num") / (2.0 * F.col("_p") * F.col("_q"))).alias("roc_auc"))


def classification_metrics(scored: DataFrame, threshold: DataFrame, score: str = "score") -> DataFrame:
    """Precision, recall, F1, F0.75, F2 and predicted-positive rate at the threshold (0 on zero
    division), and the cap on that rate that the threshold was chosen under."""
    j = scored.crossJoin(one_row(threshold.select(F.col("threshold").alias("_t"), F.col("cap").alias("_cap"))))
    pred = (F.col(score) >= F.col("_t")).cast("int")
    y = F.col("label")
    c = j.agg(F.max("_cap").alias("validation_positive_rate_cap"), F.sum(pred * y).alias("tp"), F.sum(pred * (1 - y)).alias("fp"),
              F.sum((1 - pred) * y).alias("fn"), F.count(F.lit(1)).alias("n"), F.max("_t").alias("threshold"))
    tp, fp, fn, n = F.col("tp"), F.col("fp"), F.col("fn"), F.col("n")

    def fb(b2: float):
        return F.when(tp > 0, ((1 + b2) * tp) / ((1 + b2) * tp + b2 * fn + fp)).otherwise(F.lit(0.0))

    return c.select(
        "threshold",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        fb(1.0).alias("f1"), fb(DECISION_THRESHOLD_BETA ** 2).alias("fbeta"), fb(4.0).alias("f2"),
        ((tp + fp) / n).alias("predicted_positive_rate"), "validation_positive_rate_cap")


def calibration_table(scored: DataFrame, score: str = "score", bins: int = CALIBRATION_BINS) -> DataFrame:
    """Equal-width bins over [0, 1]; a score on an inner edge goes to the lower bin."""
    edges = [i / bins for i in range(1, bins)]
    b = sum((F.col(score) > F.lit(e)).cast("int") for e in edges)
    return (scored.withColumn("bin", b).groupBy("bin")
            .agg(F.avg(F.col(score)).alias("mean_predicted"), F.avg("label").alias("fraction_positive"),
                 F.count(F.lit(1)).alias("n")))


def confusion(scored: DataFrame, threshold: DataFrame, score: str = "score") -> DataFrame:
    j = scored.crossJoin(one_row(threshold.select(F.col("threshold").alias("_t"))))
    return (j.withColumn("prediction", (F.col(score) >= F.col("_t")).cast("int"))
            .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")))


def fit_model(train: DataFrame) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features")
    gbt = GBTClassifier(featuresCol="features", labelCol="label", **GBT_PARAMS)
    return Pipeline(stages=[assembler, gbt]).fit(train)


def score_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``upset_probability``; rows and ids unchanged, empty input keeps the schema."""
    out = model.transform(df)
    return out.select(*df.columns, vector_to_array("probability")[1].alias("upset_probability"))


# ----------------------------------------------------------------- pipelines used by queries()
def split3_frame(cat: Catalog) -> DataFrame:
    return cat.memo("ml_split3", lambda c: temporal_split3(feature_frame(c)))


def validation_threshold(cat: Catalog) -> DataFrame:
    v = stand_in_score(split3_frame(cat).where(F.col("split") == "validation"))
    return threshold_search(v)


def test_scored(cat: Catalog) -> DataFrame:
    return stand_in_score(split3_frame(cat).where(F.col("split") == "test"))


# ----------------------------------------------------------------- feature attribution
class FittedTrees:
    """The trees of a fitted model as plain nested tuples: (value, rows) for a leaf,
    (feature, threshold, left, right, share of rows that go left) for a split."""

    def __init__(self, model: PipelineModel):
        gbt = model.stages[-1]
        self.weights = list(gbt.treeWeights)
        self.trees = [self._node(t._java_obj.rootNode()) for t in gbt.trees]

    def _node(self, node):
        if node.numDescendants() == 0:
            return (node.prediction(),)
        left, right = node.leftChild(), node.rightChild()
        n, m = (c.impurityStats().count() for c in (left, right))
        return (node.split().featureIndex(), node.split().threshold(), self._node(left), self._node(right), n / (n + m))

    def margin(self, x: np.ndarray, known: frozenset[int]) -> np.ndarray:
        """Expected margin of rows ``x`` when only the features ``known`` are: at other
        splits both sides count, by the training rows that went there."""
        def walk(node) -> np.ndarray | float:
            if len(node) == 1:
                return node[0]
            feature, threshold, left, right, share = node
            if feature in known:
                return np.where(x[:, feature] <= threshold, walk(left), walk(right))
            return share * walk(left) + (1 - share) * walk(right)
        return sum((w * (walk(t) + np.zeros(len(x))) for w, t in zip(self.weights, self.trees)), np.zeros(len(x)))


def _shapley_weight(s: int, n: int) -> float:
    from math import factorial
    return factorial(s) * factorial(n - s - 1) / factorial(n)


def tree_attribution(model: PipelineModel, rows: DataFrame, key: str = "match_sk") -> DataFrame:
    """Exact Shapley values of the model's margin for every row, from the trees
    themselves: one row per (key, feature), with ``position`` by size within the key.

    v(S) is the expected margin along the tree paths with the features S known, so no
    background rows are needed. sum(phi) = margin(x) - base_value. One narrow pass:
    trees x 2^4 coalitions x splits, all bounded by the model.
    """
    trees, n = FittedTrees(model), len(FEATURE_COLUMNS)
    coalitions = [frozenset(i for i in range(n) if m >> i & 1) for m in range(1 << n)]

    @F.pandas_udf("phi array<double>, base_value double, margin double")
    def attribute(*cols: pd.Series) -> pd.DataFrame:
        x = np.stack([c.to_numpy(dtype=float) for c in cols], axis=1)
        v = {c: trees.margin(x, c) for c in coalitions}
        phi = np.stack([sum(_shapley_weight(len(c), n) * (v[c | {i}] - v[c]) for c in coalitions if i not in c)
                        for i in range(n)], axis=1)
        return pd.DataFrame({"phi": list(phi), "base_value": v[coalitions[0]], "margin": v[coalitions[-1]]})

    found = rows.select(key, attribute(*FEATURE_COLUMNS).alias("a"))
    named = F.transform(F.arrays_zip(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]).alias("f"), F.col("a.phi").alias("p")),
                        lambda z: F.struct((-F.abs(z["p"])).alias("size"), z["f"].alias("feature"), z["p"].alias("phi")))
    return found.select(key, "a.base_value", "a.margin", F.posexplode(F.array_sort(named)).alias("position", "z")).select(
        key, F.col("z.feature").alias("feature"), F.col("z.phi").alias("phi"), "position", "base_value", "margin",
        (1 / (1 + F.exp(-2 * F.col("margin")))).alias("upset_probability"))
