"""Dashboard data work: filters, KPIs and display frames over the marts.

Rendering is not built; each function returns the frame a page would draw.
Filter values are parameters with the page defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import lenient_bool, region_label, team_label
from ..sources.tables import Catalog
from . import marts

# Page defaults (fixed values).
TOP_PROSPECTS = 8
GAP_CHART_PROSPECTS = 15
TOP_TEAMS = 20
DEFAULT_MIN_MAPS = 20
DAILY_WINDOW_DAYS = 14
SAMPLE_QUALITY_ORDER = ("stable", "directional", "limited")
GAP_WINDOW_LABELS = {"previous_90_day_gap_to_tier_above": "Previous 90 days",
                     "recent_90_day_gap_to_tier_above": "Recent 90 days"}


def home_kpis(cat: Catalog) -> DataFrame:
    u = marts.table(cat, "mart_upset_features").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("is_upset").cast("bigint").alias("upsets"))
    g = marts.table(cat, "mart_hidden_gems").agg(F.count(F.lit(1)).alias("hidden_gems"))
    c = marts.table(cat, "mart_choke_profile").agg(F.count(F.lit(1)).alias("pressure_teams"))
    return (u.crossJoin(g).crossJoin(c)
            .withColumn("upset_rate", F.try_divide(F.col("upsets").cast("double"),
                                                   F.nullif(F.col("matches").cast("double"), F.lit(0.0)))))


def match_filter(cat: Catalog, regions: tuple[str, ...] = ("EUROPE", "ASIA"), min_delta: int = 10,
                 outcome: str = "upset") -> DataFrame:
    """Region selection on either side, minimum ranking delta, outcome label."""
    u = marts.table(cat, "mart_upset_features")
    ra, rb = region_label("team_a_region"), region_label("team_b_region")
    cond = (ra.isin(*regions) | rb.isin(*regions)) & (F.coalesce("ranking_delta", F.lit(0)) >= min_delta)
    label = F.when(F.col("is_upset") == 1, F.lit("upset")).otherwise(F.lit("expected"))
    if outcome != "all":
        cond = cond & (label == outcome)
    return u.where(cond).select(
        "match_id", "map_name", "played_at",
        team_label("team_a_name", "team_a_id").alias("team_a"),
        team_label("team_b_name", "team_b_id").alias("team_b"),
        ra.alias("team_a_region_label"), rb.alias("team_b_region_label"),
        "ranking_delta", label.alias("outcome"), "is_cross_region")


def match_kpis(cat: Catalog) -> DataFrame:
    f = match_filter(cat, outcome="all")
    return f.agg(F.count(F.lit(1)).alias("visible_matches"),
                 F.count_if(F.col("outcome") == "upset").alias("upsets"),
                 F.sum("is_cross_region").cast("bigint").alias("cross_region"),
                 F.median("ranking_delta").alias("median_ranking_delta"))


def display_labels(cat: Catalog) -> DataFrame:
    """Labels instead of ids: team names, region labels, lenient booleans."""
    u = marts.table(cat, "mart_upset_features")
    return u.select(
        "match_sk",
        team_label("team_a_name", "team_a_id").alias("team_a"),
        team_label("team_b_name", "team_b_id").alias("team_b"),
        region_label("team_a_region").alias("team_a_region_label"),
        region_label("team_b_region").alias("team_b_region_label"),
        lenient_bool(F.col("is_overtime").cast("string")).alias("overtime_flag"),
        lenient_bool(F.col("is_upset").cast("string")).alias("upset_flag"),
    )


def gem_filter(cat: Catalog, tiers: tuple[int, ...] = (2, 3, 4), trends: tuple[str, ...] | None = None,
               min_stats: int = 3, min_recent_maps: int = 0) -> DataFrame:
    g = marts.table(cat, "mart_hidden_gems")
    cond = (F.col("player_tier").isin(*tiers) & (F.col("stats_above_tier_threshold") >= min_stats)
            & (F.coalesce("recent_90_day_maps_played", F.lit(0)) >= min_recent_maps))
    if trends:
        cond = cond & F.col("trend_direction").isin(*trends)
    return g.where(cond)


def gem_kpis(cat: Catalog) -> DataFrame:
    g = gem_filter(cat)
    return g.agg(F.count(F.lit(1)).alias("prospects"),
                 F.median("prospect_score").alias("median_prospect_score"),
                 F.median("matches_played").alias("median_maps"),
                 F.count_if(F.col("trend_direction") == "gap_growing").alias("gap_growing"))


def top_gems(cat: Catalog, n: int = TOP_PROSPECTS) -> DataFrame:
    """Top prospects by score; ties broken by player id (a top-k report)."""
    g = marts.table(cat, "mart_hidden_gems")
    return (g.orderBy(F.col("prospect_score").desc(), F.col("player_id").asc(), F.col("team_id").asc())
            .limit(n).select("player_id", "display_name", "team_id", "player_tier", "prospect_score",
                             "trend_direction"))


def gap_chart(cat: Catalog, n: int = GAP_CHART_PROSPECTS) -> DataFrame:
    """Top prospects in long form: one row per (player, window) with a label."""
    top = (marts.table(cat, "mart_hidden_gems")
           .orderBy(F.col("prospect_score").desc(), F.col("player_id").asc(), F.col("team_id").asc())
           .limit(n))
    long = top.select("player_id", "display_name", F.expr(
        "stack(2, 'previous_90_day_gap_to_tier_above', previous_90_day_gap_to_tier_above, "
        "'recent_90_day_gap_to_tier_above', recent_90_day_gap_to_tier_above) as (window, gap)"))
    label = F.when(F.col("window") == "recent_90_day_gap_to_tier_above", F.lit(GAP_WINDOW_LABELS[
        "recent_90_day_gap_to_tier_above"])).otherwise(F.lit(GAP_WINDOW_LABELS["previous_90_day_gap_to_tier_above"]))
    return long.select("player_id", "display_name", label.alias("window"), "gap")


def team_filter(cat: Catalog, min_maps: int = DEFAULT_MIN_MAPS,
                qualities: tuple[str, ...] = ("stable", "directional"),
                metric: str = "lead_blown_rate", n: int = TOP_TEAMS) -> DataFrame:
    """Teams with enough maps and sample quality, the first ``n`` by the metric."""
    c = marts.table(cat, "mart_choke_profile")
    f = c.where((F.col("total_maps") >= min_maps) & F.col("sample_quality").isin(*qualities)
                & F.col(metric).isNotNull())
    return (f.orderBy(F.col(metric).desc_nulls_last(), F.col("team_id").asc()).limit(n)
            .select("team_id", "team_name", "total_maps", "sample_quality", F.col(metric).alias("metric_value")))


def team_kpis(cat: Catalog) -> DataFrame:
    c = marts.table(cat, "mart_choke_profile")
    return c.agg(F.sum("total_maps").cast("bigint").alias("maps"),
                 F.sum("rounds_analyzed").cast("bigint").alias("rounds"),
                 F.median("lead_blown_rate").alias("median_lead_blown_rate"),
                 F.median("comeback_rate").alias("median_comeback_rate"),
                 F.median("ot_win_rate").alias("median_ot_win_rate"),
                 F.median("close_map_win_rate").alias("median_close_map_win_rate"))


def scatter(cat: Catalog) -> DataFrame:
    c = marts.table(cat, "mart_choke_profile")
    return c.dropna(subset=["lead_blown_rate", "comeback_rate"]).select(
        "team_id", "team_name", "lead_blown_rate", "comeback_rate", "total_maps")


def value_counts(cat: Catalog) -> DataFrame:
    """Trend distribution of prospects and sample-quality distribution of teams."""
    g = marts.table(cat, "mart_hidden_gems").groupBy(
        F.coalesce("trend_direction", F.lit("unknown")).alias("value")).count()
    c = marts.table(cat, "mart_choke_profile").groupBy(
        F.coalesce("sample_quality", F.lit("unknown")).alias("value")).count()
    return (g.select(F.lit("trend_direction").alias("metric"), "value", F.col("count").alias("n"))
            .unionByName(c.select(F.lit("sample_quality").alias("metric"), "value", F.col("count").alias("n"))))


def daily_series(cat: Catalog, days: int = DAILY_WINDOW_DAYS) -> DataFrame:
    """Matches and upsets per date for the newest ``days`` dates with data."""
    u = marts.table(cat, "mart_upset_features").select(F.col("played_at").try_cast("date").alias("d"), "is_upset")
    per_day = u.where(F.col("d").isNotNull()).groupBy("d").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("is_upset").cast("bigint").alias("upsets"))
    return per_day.orderBy(F.col("d").desc()).limit(days)


def limited_share(cat: Catalog) -> DataFrame:
    c = marts.table(cat, "mart_choke_profile")
    return c.agg(F.avg((F.col("sample_quality") == "limited").cast("int")).alias("limited_share"))


def filter_bounds(cat: Catalog) -> DataFrame:
    """Upper bounds for the page sliders: max of a coerced column, at least 1."""
    def bound(df: DataFrame, c: str) -> DataFrame:
        return df.agg(F.greatest(F.coalesce(F.max(F.col(c).try_cast("int")), F.lit(1)), F.lit(1)).alias("bound"))
    u = bound(marts.table(cat, "mart_upset_features"), "ranking_delta").select(F.lit("ranking_delta").alias("column"), "bound")
    g = bound(marts.table(cat, "mart_hidden_gems"), "matches_played").select(F.lit("matches_played").alias("column"), "bound")
    c = bound(marts.table(cat, "mart_choke_profile"), "total_maps").select(F.lit("total_maps").alias("column"), "bound")
    return u.unionByName(g).unionByName(c)


def region_slots(cat: Catalog) -> DataFrame:
    """Region labels of both sides of every match, counted."""
    u = marts.table(cat, "mart_upset_features")
    return (u.select(F.explode(F.array(region_label("team_a_region"), region_label("team_b_region"))).alias("region"))
            .groupBy("region").agg(F.count(F.lit(1)).alias("slots")))


def distinct_regions(cat: Catalog) -> DataFrame:
    u = marts.table(cat, "mart_upset_features")
    return (u.select(F.explode(F.array("team_a_region", "team_b_region")).alias("region"))
            .where(F.col("region").isNotNull()).distinct().orderBy("region"))
