"""Registered queries for lookups, data quality, serving and scalar operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import exact_avg, lenient_bool, surrogate_key, tier
from ..operators import dq
from ..operators.joins import broadcast_if_small
from ..sources import standins as raw
from ..sources.tables import Catalog
from . import core, lookups, marts, rules, serving, staging as stg
from ..streaming.manifest import LoadManifest
from .registry import query


# --------------------------------------------------------------------------- dedupe / lookup steps
@query("latest_snapshot_filter")
def q_latest_snapshot_filter(cat: Catalog) -> DataFrame:
    """DDP-05: valve rows of the newest snapshot only."""
    return core.latest_valve_regions(cat)


@query("unique_keys_only")
def q_unique_keys_only(cat: Catalog) -> DataFrame:
    """DDP-06: normalised liquipedia names seen exactly once."""
    return core.liquipedia_region_names(cat)


@query("unambiguous_values")
def q_unambiguous_values(cat: Catalog) -> DataFrame:
    """DDP-07 / AGG-12: names with one distinct region (normalised and exact)."""
    a = core.valve_region_names(cat).select(F.lit("normalized").alias("kind"),
                                            F.col("normalized_team_name").alias("name_key"), "region")
    b = core.exact_valve_region_names(cat).select(F.lit("exact").alias("kind"),
                                                  F.col("team_name_key").alias("name_key"), "region")
    return a.unionByName(b)


@query("join_cascade_lookup")
def q_join_cascade_lookup(cat: Catalog) -> DataFrame:
    """JON-04: region cascade for ranking rows (own, liquipedia, valve exact, valve normalised)."""
    return core.csapi_team_rows(cat)


@query("join_dim_left")
def q_join_dim_left(cat: Catalog) -> DataFrame:
    """JON-01: fact left join the map dimension by name."""
    f = core.table(cat, "fact_matches").select("match_sk", "map_name")
    d = broadcast_if_small(core.dim_maps(cat).select(F.col("map_name").alias("_m"), F.col("map_sk").alias("dim_map_sk")))
    return f.join(d, f["map_name"] == d["_m"], "left").select("match_sk", "map_name", "dim_map_sk")


@query("join_computed_key")
def q_join_computed_key(cat: Catalog) -> DataFrame:
    """JON-03: stat rows joined to the team of coalesce(current team, row team)."""
    return marts.player_match_stats(cat)


@query("join_tier_above")
def q_join_tier_above(cat: Catalog) -> DataFrame:
    """JON-05: each tier 2-4 player with the thresholds of tier - 1."""
    s = marts.hidden_gems_scored(cat)
    return s.select("player_id", "display_name", "team_id", "player_tier", "adr_threshold", "kd_threshold",
                    "kast_threshold", "rating_threshold")


@query("asof_ranking")
def q_asof_ranking(cat: Catalog) -> DataFrame:
    """JON-09 / SCL-19: rank as of the newest snapshot 1-15 days before the match."""
    return lookups.asof_ranking(cat)


@query("anti_join_loaded")
def q_anti_join_loaded(cat: Catalog) -> DataFrame:
    """JON-11: the keys that a second load found missing in the manifest of the first, and wrote."""
    def load(folder: str) -> None:
        lookups.second_load(cat, folder)

    manifest = LoadManifest(cat.spark, cat.stored("two_loads", load) + "/manifest")
    new = manifest.loaded().where(F.col("load_id") == "load-2").select("object_key")
    return lookups.batch_keys(cat).join(new, "object_key").select("source", "d", "object_key")


@query("semi_join_selection")
def q_semi_join_selection(cat: Catalog) -> DataFrame:
    """JON-12: matches with either region in the selection."""
    return lookups.selection_semi_join(cat)


@query("latest_complete_snapshot")
def q_latest_complete_snapshot(cat: Catalog) -> DataFrame:
    """SRC-08: newest complete standings snapshot from a file listing."""
    return lookups.latest_complete_snapshot(cat)


@query("match_window")
def q_match_window(cat: Catalog) -> DataFrame:
    """SRC-10: newest matches of the daily profile (cap 150)."""
    return lookups.match_window(cat)


@query("win_partition_max")
def q_win_partition_max(cat: Catalog) -> DataFrame:
    """WIN-03: map-wide maxima on every round row (aggregate joined back on the map key)."""
    r = stg.stg_hltv_round_history(cat)
    per_map = r.groupBy("map_stats_id").agg(F.max("round_number").alias("total_rounds"),
                                            F.max("score_team1_after").alias("final_team1_score"),
                                            F.max("score_team2_after").alias("final_team2_score"))
    return r.select("map_stats_id", "round_number", "team1_id", "team2_id").join(per_map, "map_stats_id")


# --------------------------------------------------------------------------- data quality
@query("dq_not_null")
def q_dq_not_null(cat: Catalog) -> DataFrame:
    """DQ-01: every not-null rule of every model."""
    return rules.check(cat, "not_null")


@query("dq_unique")
def q_dq_unique(cat: Catalog) -> DataFrame:
    """DQ-02 / DQ-07: key uniqueness, including the fact grain after reloads."""
    f = core.table(cat, "fact_matches")
    return dq.stack([
        dq.unique("fact_matches", f, ["match_sk"]),
        dq.unique("fact_matches", f, ["match_id", "source", "map_name"]),
        dq.unique("fact_player_stats", core.table(cat, "fact_player_stats"), ["player_stat_sk"]),
        dq.unique("dim_teams", core.table(cat, "dim_teams"), ["team_id"]),
        dq.unique("dim_players", core.table(cat, "dim_players"), ["player_id"]),
    ])


@query("dq_unique_models")
def q_dq_unique_models(cat: Catalog) -> DataFrame:
    """DQ-02: the unique rules of staging, map dimension and marts."""
    return rules.unique_models(cat)


@query("dq_accepted_values")
def q_dq_accepted_values(cat: Catalog) -> DataFrame:
    """DQ-03: every accepted-values rule of every model."""
    return rules.check(cat, "accepted_values")


@query("dq_relationship")
def q_dq_relationship(cat: Catalog) -> DataFrame:
    """DQ-04 / JON-10: every stat row's player exists in dim_players (left anti)."""
    return dq.relationship("fact_player_stats", core.table(cat, "fact_player_stats"), "player_id",
                           core.table(cat, "dim_players"), "player_id")


@query("dq_expression")
def q_dq_expression(cat: Catalog) -> DataFrame:
    """DQ-05: every expression that must hold (counts that must not be negative)."""
    return rules.check(cat, "expression_is_true")


@query("dq_non_empty")
def q_dq_non_empty(cat: Catalog) -> DataFrame:
    """DQ-06 / SET-09: stacked row counts of the marts that must not be empty."""
    return dq.non_empty({name: marts.table(cat, name) for name in (
        "mart_team_performance", "mart_player_leaderboard", "mart_upset_features", "mart_choke_profile")})


# --------------------------------------------------------------------------- serving
@query("serve_home_kpis")
def q_serve_home_kpis(cat: Catalog) -> DataFrame:
    return serving.home_kpis(cat)


@query("serve_match_filter")
def q_serve_match_filter(cat: Catalog) -> DataFrame:
    return serving.match_filter(cat)


@query("serve_match_kpis")
def q_serve_match_kpis(cat: Catalog) -> DataFrame:
    return serving.match_kpis(cat)


@query("scalar_labels")
def q_scalar_labels(cat: Catalog) -> DataFrame:
    """SCL-15/16/23, SRV-04: display labels."""
    return serving.display_labels(cat)


@query("serve_gem_filter")
def q_serve_gem_filter(cat: Catalog) -> DataFrame:
    return serving.gem_filter(cat)


@query("serve_gem_kpis")
def q_serve_gem_kpis(cat: Catalog) -> DataFrame:
    return serving.gem_kpis(cat)


@query("topk_gems")
def q_topk_gems(cat: Catalog) -> DataFrame:
    return serving.top_gems(cat)


@query("melt_gap_windows")
def q_melt_gap_windows(cat: Catalog) -> DataFrame:
    """SET-08 / TOP-02: top 15 prospects, gap windows in long form."""
    return serving.gap_chart(cat)


@query("serve_team_filter")
def q_serve_team_filter(cat: Catalog) -> DataFrame:
    """SRV-08 / TOP-03: first 20 teams by lead-blown rate."""
    return serving.team_filter(cat)


@query("serve_team_kpis")
def q_serve_team_kpis(cat: Catalog) -> DataFrame:
    return serving.team_kpis(cat)


@query("serve_scatter")
def q_serve_scatter(cat: Catalog) -> DataFrame:
    return serving.scatter(cat)


@query("agg_value_counts")
def q_agg_value_counts(cat: Catalog) -> DataFrame:
    return serving.value_counts(cat)


@query("agg_daily")
def q_agg_daily(cat: Catalog) -> DataFrame:
    return serving.daily_series(cat)


@query("agg_share")
def q_agg_share(cat: Catalog) -> DataFrame:
    return serving.limited_share(cat)


@query("agg_bound")
def q_agg_bound(cat: Catalog) -> DataFrame:
    return serving.filter_bounds(cat)


@query("region_slots")
def q_region_slots(cat: Catalog) -> DataFrame:
    return serving.region_slots(cat)


@query("distinct_sorted")
def q_distinct_sorted(cat: Catalog) -> DataFrame:
    return serving.distinct_regions(cat)


# --------------------------------------------------------------------------- scalar functions
@query("scalar_tier")
def q_scalar_tier(cat: Catalog) -> DataFrame:
    """SCL-03: tier buckets (null rank -> 4)."""
    t = core.table(cat, "dim_teams")
    return t.select("team_id", "world_ranking", tier("world_ranking").alias("tier"))


@query("scalar_null")
def q_scalar_null(cat: Catalog) -> DataFrame:
    """SCL-01/02/11: coalesce with defaults, nullif guards, placeholder to null."""
    r = stg.stg_csapi_team_rankings(cat)
    return r.select("team_id", "ranking_date",
                    F.coalesce("world_ranking", F.lit(999)).alias("rank_or_default"),
                    F.try_divide(F.col("vrs_points").cast("double"),
                                 F.nullif(F.col("rank_diff"), F.lit(0)).cast("double")).alias("points_per_rank_step"),
                    F.when(F.lower("region") == "global", F.lit(None)).otherwise(F.col("region")).alias("region"))


@query("scalar_math")
def q_scalar_math(cat: Catalog) -> DataFrame:
    """SCL-04/05: abs, greatest/least, arithmetic and rounding on integer ratios."""
    u = marts.table(cat, "mart_upset_features")
    return u.select("match_sk", F.abs(F.col("score_diff")).alias("abs_diff"),
                    F.greatest("score_a", "score_b").alias("high_score"),
                    F.least("score_a", "score_b").alias("low_score"),
                    F.round(F.col("score_a") / F.nullif(F.col("total_rounds"), F.lit(0)), 4).alias("share_a"))


@query("scalar_surrogate_key")
def q_scalar_surrogate_key(cat: Catalog) -> DataFrame:
    """SCL-06: md5 surrogate keys with null markers."""
    f = core.table(cat, "fact_matches")
    return f.select("match_sk", surrogate_key("match_id", "winner_id").alias("match_winner_sk"),
                    surrogate_key("map_name").alias("map_sk2"))


@query("scalar_cast")
def q_scalar_cast(cat: Catalog) -> DataFrame:
    """SCL-07/08/18: casts, lenient timestamps and numeric coercion with null on failure."""
    r = raw.raw_hltv_round_history(cat)
    return r.select("map_stats_id", F.col("round_number").cast("int").alias("round_number"),
                    F.try_to_timestamp("played_at").cast("timestamp_ntz").alias("played_ts"),
                    F.col("reported_score").try_cast("int").alias("reported_as_int"),
                    F.split("reported_score", "-").getItem(0).try_cast("int").alias("reported_team1"),
                    F.col("is_overtime").cast("int").alias("overtime_int"))


@query("scalar_date")
def q_scalar_date(cat: Catalog) -> DataFrame:
    """SCL-09/24: text to date, day offsets and comparisons."""
    f = core.table(cat, "fact_matches").select("match_sk", F.col("played_at").try_cast("date").alias("d"))
    return f.where(F.col("d").isNotNull()).select(
        "match_sk", "d", F.date_sub("d", 1).alias("day_before"), F.date_sub("d", 89).alias("window_start"),
        (F.col("d") >= F.lit("2000-01-01").cast("date")).alias("is_recent"))


@query("scalar_ratio")
def q_scalar_ratio(cat: Catalog) -> DataFrame:
    """SCL-12: guarded kd and kill share."""
    s = core.table(cat, "fact_player_stats")
    return s.select("player_stat_sk", "computed_kd", "kill_share")


@query("scalar_flags")
def q_scalar_flags(cat: Catalog) -> DataFrame:
    """SCL-14: boolean columns and 0/1 flags under three-valued logic."""
    u = marts.table(cat, "mart_upset_features")
    return u.select("match_sk", "is_cross_region", (F.col("ranking_delta") > 5).alias("delta_over_5"),
                    (F.col("team_a_region") != F.col("team_b_region")).alias("regions_differ"))


@query("scalar_bool")
def q_scalar_bool(cat: Catalog) -> DataFrame:
    """SCL-16: lenient booleans from text."""
    e = cat.table("events").select("event_id", "event_type")
    return e.select("event_id", lenient_bool(F.when(F.col("event_type") == "click", F.lit("Yes"))
                                             .when(F.col("event_type") == "view", F.lit(" true "))
                                             .when(F.col("event_type") == "error", F.lit("0"))
                                             .when(F.col("event_type") == "signup", F.lit("N"))
                                             .otherwise(F.col("event_type"))).alias("flag"))


@query("scalar_record")
def q_scalar_record(cat: Catalog) -> DataFrame:
    """SCL-17: record text, close-map losses, rate text with 'n/a'."""
    c = marts.table(cat, "mart_choke_profile")
    rate = F.round(F.col("close_map_win_rate") * 100, 1)
    return c.select("team_id",
                    F.concat_ws("-", F.col("wins").cast("string"), F.col("losses").cast("string")).alias("record"),
                    F.greatest(F.col("close_maps") - F.col("close_map_wins"), F.lit(0)).alias("close_map_losses"),
                    F.when(rate.isNull(), F.lit("n/a")).otherwise(F.concat(rate.cast("string"), F.lit("%")))
                    .alias("close_rate_text"))


@query("json_extract")
def q_json_extract(cat: Catalog) -> DataFrame:
    """SCL-20: JSON field access (path and typed struct)."""
    e = cat.table("events").select("event_id", "props")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k_path"),
                    F.from_json("props", "k int").getField("k").alias("k_struct"))


@query("agg_player")
def q_agg_player(cat: Catalog) -> DataFrame:
    """AGG-05/06: exact per-player averages by (player, name, team)."""
    j = marts.player_match_stats(cat)
    return j.groupBy("player_id", "display_name", "team_id").agg(
        F.count(F.lit(1)).alias("matches_played"), exact_avg("adr").alias("avg_adr"),
        exact_avg("kast").alias("avg_kast"), F.max("recorded_at").alias("latest"))
