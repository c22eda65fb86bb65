"""Registered queries of the planned features (EXT-01 to EXT-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.tables import Catalog
from . import features
from .registry import query


@query("rolling_form")
def q_rolling_form(cat: Catalog) -> DataFrame:
    """EXT-01: win rate over the last ten matches before the match."""
    return features.rolling_form(cat)


@query("prior_records")
def q_prior_records(cat: Catalog) -> DataFrame:
    """EXT-02: head-to-head and per-map win rates before the match."""
    return features.prior_records(cat)


@query("rating_differential")
def q_rating_differential(cat: Catalog) -> DataFrame:
    """EXT-03: average player ratings before the match."""
    return features.rating_differential(cat)


@query("upset_rate_by_gap")
def q_upset_rate_by_gap(cat: Catalog) -> DataFrame:
    """EXT-04: upset rate by ranking gap."""
    return features.upset_rate_by_gap(cat)


@query("pressure_rates")
def q_pressure_rates(cat: Catalog) -> DataFrame:
    """EXT-05: blown leads of ten rounds, comebacks from three behind at half."""
    return features.pressure_rates(cat)


@query("better_cohort_percentiles")
def q_better_cohort_percentiles(cat: Catalog) -> DataFrame:
    """EXT-06: percentile of each player's averages in the better tier's cohort."""
    return features.better_cohort_percentiles(cat)
