"""Registered queries for staging, unions, dedupes, the star schema and the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Catalog
from . import core, marts, staging as stg
from .registry import query


@query("stg_matches")
def q_stg_matches(cat: Catalog) -> DataFrame:
    """STG-01/02: faceit and pandascore matches, rankings forced null."""
    return stg.stg_faceit_matches(cat).unionByName(stg.stg_pandascore_matches(cat))


@query("stg_matches_ranked")
def q_stg_matches_ranked(cat: Catalog) -> DataFrame:
    """STG-03: csapi matches keep rankings and need both team ids."""
    return stg.stg_csapi_matches(cat)


@query("stg_players")
def q_stg_players(cat: Catalog) -> DataFrame:
    """STG-04..06: the three player sources (rating forced null for two)."""
    return reduce(DataFrame.unionByName, [stg.stg_faceit_players(cat), stg.stg_pandascore_players(cat),
                                          stg.stg_csapi_player_stats(cat)])


@query("stg_rankings")
def q_stg_rankings(cat: Catalog) -> DataFrame:
    """STG-07: csapi rankings with team and rank present."""
    return stg.stg_csapi_team_rankings(cat)


@query("stg_rounds")
def q_stg_rounds(cat: Catalog) -> DataFrame:
    """STG-10: round history with casts and lenient timestamps."""
    return stg.stg_hltv_round_history(cat)


@query("union_matches")
def q_union_matches(cat: Catalog) -> DataFrame:
    """SET-01 / MRT-01: all match sources."""
    return stg.int_matches_unioned(cat)


@query("union_players")
def q_union_players(cat: Catalog) -> DataFrame:
    """SET-02: all player sources before the dedupe."""
    return stg.players_unioned_raw(cat)


@query("dedupe_priority")
def q_dedupe_priority(cat: Catalog) -> DataFrame:
    """DDP-01 / MRT-02: one row per (player, match or profile) by provider priority."""
    return stg.int_players_unioned(cat)


@query("dim_maps")
def q_dim_maps(cat: Catalog) -> DataFrame:
    return core.dim_maps(cat)


@query("dim_players")
def q_dim_players(cat: Catalog) -> DataFrame:
    return core.dim_players(cat)


@query("dim_teams")
def q_dim_teams(cat: Catalog) -> DataFrame:
    return core.dim_teams(cat)


@query("fact_matches")
def q_fact_matches(cat: Catalog) -> DataFrame:
    return core.fact_matches(cat)


@query("fact_player_stats")
def q_fact_player_stats(cat: Catalog) -> DataFrame:
    return core.fact_player_stats(cat)


@query("mart_upset_features")
def q_mart_upset_features(cat: Catalog) -> DataFrame:
    return marts.mart_upset_features(cat)


@query("mart_team_performance")
def q_mart_team_performance(cat: Catalog) -> DataFrame:
    return marts.mart_team_performance(cat)


@query("mart_head2head")
def q_mart_head2head(cat: Catalog) -> DataFrame:
    return marts.mart_head2head(cat)


@query("mart_map_meta")
def q_mart_map_meta(cat: Catalog) -> DataFrame:
    return marts.mart_map_meta(cat)


@query("mart_player_leaderboard")
def q_mart_player_leaderboard(cat: Catalog) -> DataFrame:
    return marts.mart_player_leaderboard(cat)


@query("mart_hidden_gems")
def q_mart_hidden_gems(cat: Catalog) -> DataFrame:
    return marts.mart_hidden_gems(cat)


@query("mart_choke_profile")
def q_mart_choke_profile(cat: Catalog) -> DataFrame:
    return marts.mart_choke_profile(cat)


@query("agg_percentile")
def q_agg_percentile(cat: Catalog) -> DataFrame:
    """AGG-07: exact 85th percentile of four player averages per tier."""
    return marts.tier_thresholds(cat)


@query("agg_trend_windows")
def q_agg_trend_windows(cat: Catalog) -> DataFrame:
    """AGG-08 / WIN-04: 90-day windows against each player's latest date."""
    return marts.player_trends(cat)


@query("agg_map_team")
def q_agg_map_team(cat: Catalog) -> DataFrame:
    """AGG-09 / MRT-15a: per (map, team) summary of mirrored rounds."""
    return marts.map_team_summary(cat)


@query("map_team_flags")
def q_map_team_flags(cat: Catalog) -> DataFrame:
    """MRT-15b: per-map pressure flags."""
    return marts.map_team_flags(cat)


@query("agg_team_pressure")
def q_agg_team_pressure(cat: Catalog) -> DataFrame:
    """AGG-10: team roll-up of the flags with nullable rates."""
    return marts.team_pressure(cat)


@query("agg_league")
def q_agg_league(cat: Catalog) -> DataFrame:
    """AGG-11: league averages (grand total over the team aggregate)."""
    return marts.league_averages(marts.team_pressure(cat))


@query("mirror_team_rounds")
def q_mirror_team_rounds(cat: Catalog) -> DataFrame:
    """SET-05: rounds from both teams' side with scores before the round."""
    return marts.mirrored_team_rounds(cat)


@query("unpivot_team_rows")
def q_unpivot_team_rows(cat: Catalog) -> DataFrame:
    """SET-04: each match as two team rows with win/loss/draw flags."""
    return marts.team_match_rows(cat)


@query("gem_gap")
def q_gem_gap(cat: Catalog) -> DataFrame:
    """MRT-13a: gap to the tier above for every tier 2-4 player (before the gem filter)."""
    s = marts.hidden_gems_scored(cat)
    return s.select("player_id", "display_name", "team_id", "player_tier", "stats_above_tier_threshold",
                    F.round("recent_90_day_gap_to_tier_above", 6).alias("recent_gap"),
                    F.round("previous_90_day_gap_to_tier_above", 6).alias("previous_gap"))
