"""The data-quality rules of every model, as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import dq
from ..operators.dq import Model
from ..sources.tables import Catalog
from . import core, marts
from . import staging as stg

PROVIDERS = ("faceit", "pandascore", "csapi")
COUNTS = ("maps_analyzed", "rounds_analyzed", "overtime_maps_analyzed", "close_maps_analyzed", "maps_with_5plus_lead",
          "minimum_stable_maps", "halftime_leads_lost")

# Per model the column that names its rows in reports, then the columns that must not be
# null, the values that are accepted and the columns that must not be negative.
RULES = (
    Model("stg_faceit_matches", "match_id", ("match_id", "source", "team_a_id", "team_b_id", "played_at"), {"source": ("faceit",)}),
    Model("stg_pandascore_matches", "match_id", ("match_id", "source"), {"source": ("pandascore",)}),
    Model("stg_csapi_matches", "match_id", ("match_id", "source", "team_a_id", "team_b_id", "played_at"), {"source": ("csapi",)}),
    Model("stg_csapi_team_rankings", "team_id", ("team_id", "source", "world_ranking", "ranking_date"), {"source": ("csapi",)}),
    Model("stg_csapi_player_stats", "player_id", ("player_id", "source"), {"source": ("csapi",)}),
    Model("stg_valve_team_regions", "team_name", ("snapshot_date", "source", "normalized_team_name", "region"), {"source": ("valve",)}),
    Model("stg_hltv_round_history", "map_stats_id", ("source", "map_stats_id", "round_number", "winner_side", "winner_team_id"),
          {"source": ("hltv_unofficial",), "winner_side": ("t", "ct")}),
    Model("stg_faceit_players", "player_id", ("player_id", "source", "recorded_at")),
    Model("stg_pandascore_players", "player_id", ("player_id", "source")),
    Model("stg_liquipedia_teams", "team_id", ("team_id", "name", "ingested_at")),
    Model("int_matches_unioned", "match_id", ("match_id", "source"), {"source": PROVIDERS}),
    Model("int_players_unioned", "player_id", ("player_id", "source"), {"source": PROVIDERS}),
    Model("fact_matches", "match_sk", ("match_sk", "match_id", "source", "team_a_id", "played_at")),
    Model("fact_player_stats", "player_stat_sk", ("player_stat_sk", "player_id", "match_id")),
    Model("dim_teams", "team_id", ("team_id", "team_name")),
    Model("dim_players", "player_id", ("player_id", "display_name")),
    Model("dim_maps", "map_sk", ("map_sk", "map_name")),
    Model("mart_team_performance", "team_id", ("team_id", "win_rate")),
    Model("mart_player_leaderboard", "player_id", ("player_id",)),
    Model("mart_map_meta", "map_name", ("map_name", "pick_rate")),
    Model("mart_head2head", "team_1_id", ("team_1_id", "team_2_id", "total_matches")),
    Model("mart_upset_features", "match_sk", ("match_sk", "is_upset"), {"is_upset": (0, 1)}),
    Model("mart_hidden_gems", "player_id",
          ("player_id", "is_hidden_gem", "prospect_score", "recent_90_day_maps_played", "minimum_recent_90_day_maps",
           "meets_recent_sample_size", "trend_direction"),
          {"trend_direction": ("gap_growing", "gap_shrinking", "gap_flat", "insufficient_history")}),
    Model("mart_choke_profile", "team_id",
          ("team_id", "team_name", *COUNTS, "sample_quality", "lead_blown_rate_display", "halftime_comeback_rate_display",
           "comeback_metric_type", "halftime_data_available", "metric_source", "round_history_available",
           "clutch_data_available", "bracket_data_available", "sample_size_warning"),
          {"sample_quality": ("limited", "directional", "stable"), "metric_source": ("hltv_unofficial",)}, COUNTS),
)

# The columns whose values must be unique, beside the keys of facts and dimensions (``dq_unique``).
UNIQUE = (("dim_maps", "map_sk"), ("dim_maps", "map_name"), ("stg_liquipedia_teams", "team_id"), ("mart_team_performance", "team_id"),
          ("mart_map_meta", "map_name"), ("mart_upset_features", "match_sk"), ("mart_choke_profile", "team_id"))

READERS: dict[str, Callable[[Catalog], DataFrame]] = {
    **{name: getattr(stg, name) for name in (
        "stg_faceit_matches", "stg_pandascore_matches", "stg_csapi_matches", "stg_csapi_team_rankings", "stg_csapi_player_stats",
        "stg_valve_team_regions", "stg_hltv_round_history", "stg_faceit_players", "stg_pandascore_players", "stg_liquipedia_teams",
        "int_matches_unioned")},
    "int_players_unioned": core.players,
    "dim_maps": core.dim_maps,
}


def read(cat: Catalog, model: str) -> DataFrame:
    """A model as its readers get it: views are computed, tables read."""
    if model in READERS:
        return READERS[model](cat)
    return core.table(cat, model) if model in core.CORE_TABLES else marts.table(cat, model)


def check(cat: Catalog, *kinds: str) -> DataFrame:
    """All rules of some kinds (not_null, accepted_values, expression_is_true): one aggregate over each model that has any."""
    return dq.stack([dq.model_rules(m, read(cat, m.name), kinds) for m in RULES if m.rules(kinds)])


def unique_models(cat: Catalog) -> DataFrame:
    """The rules of ``UNIQUE``: how many values occur more than once."""
    return dq.stack([dq.unique(model, read(cat, model), [column]) for model, column in UNIQUE])
