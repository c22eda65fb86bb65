"""Registered queries for the model job (section 2.14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Catalog
from . import ml
from .registry import query


@query("ml_features")
def q_ml_features(cat: Catalog) -> DataFrame:
    """ML-03: feature matrix with the null rules."""
    return ml.feature_frame(cat)


@query("temporal_split")
def q_temporal_split(cat: Catalog) -> DataFrame:
    """ML-01 / WIN-07: newest 20 % as holdout in global time order."""
    return ml.temporal_split(ml.feature_frame(cat)).select("match_sk", "played_at", "split")


@query("temporal_split3")
def q_temporal_split3(cat: Catalog) -> DataFrame:
    """ML-02: train / validation / test, 60 / 20 / 20 in time order."""
    return ml.split3_frame(cat).select("match_sk", "played_at", "split")


@query("ml_threshold")
def q_ml_threshold(cat: Catalog) -> DataFrame:
    """ML-06: best F0.75 threshold on validation with the positive-rate cap."""
    return ml.validation_threshold(cat)


@query("ml_metrics")
def q_ml_metrics(cat: Catalog) -> DataFrame:
    """ML-07: holdout metrics at the validation threshold, with ROC-AUC."""
    t = ml.test_scored(cat)
    m = ml.classification_metrics(t, ml.validation_threshold(cat))
    return m.crossJoin(ml.roc_auc(t))


@query("ml_auc")
def q_ml_auc(cat: Catalog) -> DataFrame:
    """ML-08: rank-sum ROC-AUC with ties over all labelled matches."""
    return ml.roc_auc(ml.stand_in_score(ml.feature_frame(cat)))


@query("ml_calibration")
def q_ml_calibration(cat: Catalog) -> DataFrame:
    """ML-09: calibration table, 5 equal-width bins."""
    return ml.calibration_table(ml.test_scored(cat))


@query("ml_confusion")
def q_ml_confusion(cat: Catalog) -> DataFrame:
    """ML-10 / ML-12: confusion counts at the threshold (watchlist = predicted positive)."""
    return ml.confusion(ml.test_scored(cat), ml.validation_threshold(cat))


@query("ml_score")
def q_ml_score(cat: Catalog) -> DataFrame:
    """ML-04 / ML-05: boosted trees fitted on the train part, holdout scored; what must hold
    for every row (the probabilities themselves are the learner's)."""
    s = ml.split3_frame(cat)
    model = ml.fit_model(s.where(F.col("split") == "train"))
    scored = ml.score_rows(model, s.where(F.col("split") == "test"))
    return scored.select("match_sk", "played_at", "label",
                         F.col("upset_probability").between(0.0, 1.0).alias("is_probability"))


@query("ml_attribution")
def q_ml_attribution(cat: Catalog) -> DataFrame:
    """ML-11: attribution of every holdout row to its features (tree paths): the parts add
    up to the model's own margin and give its probability."""
    s = ml.split3_frame(cat)
    model = ml.fit_model(s.where(F.col("split") == "train"))
    test = s.where(F.col("split") == "test")
    own = ml.score_rows(model, test).select("match_sk", F.col("upset_probability").alias("own"))
    parts = ml.tree_attribution(model, test).groupBy("match_sk").agg(
        F.count(F.lit(1)).alias("features"), F.sum("phi").alias("phi"), F.max("base_value").alias("base"),
        F.max("margin").alias("margin"), F.max("upset_probability").alias("p"))
    return parts.join(own, "match_sk").select(
        "match_sk", "features", (F.abs(F.col("base") + F.col("phi") - F.col("margin")) < 1e-6).alias("adds_up"),
        (F.abs(F.col("p") - F.col("own")) < 1e-6).alias("is_model_score"))
