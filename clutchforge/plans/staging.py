"""Staging views (one per raw table) and the intermediate unions.

Staging = projection + constant source + not-null filters; Catalyst pushes the
filters into the scans of the raw tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import PLAYER_SOURCE_PRIORITY, PROFILE_KEY, source_priority
from ..operators.dedupe import keep_first
from ..sources import standins as raw
from ..sources.tables import Catalog

MATCH_COLS = ["match_id", "source", "team_a_id", "team_b_id", "winner_id", "played_at", "map_name",
              "score_a", "score_b", "is_overtime", "team_a_ranking", "team_b_ranking"]
PLAYER_COLS = ["player_id", "source", "display_name", "team_id", "nationality", "kills", "deaths", "adr",
               "kd_ratio", "kast", "rating", "elo", "match_id", "recorded_at"]


def _null(t: str, name: str):
    return F.lit(None).cast(t).alias(name)


def _match_stage(df: DataFrame, source: str, keep_rankings: bool, need_teams: bool) -> DataFrame:
    cond = F.col("match_id").isNotNull()
    if need_teams:
        cond = cond & F.col("team_a_id").isNotNull() & F.col("team_b_id").isNotNull()
    cols = [F.col(c) for c in MATCH_COLS[:10]]
    cols[1] = F.lit(source).alias("source")
    if keep_rankings:
        cols += [F.col("team_a_ranking").cast("bigint"), F.col("team_b_ranking").cast("bigint")]
    else:
        cols += [_null("bigint", "team_a_ranking"), _null("bigint", "team_b_ranking")]
    return df.filter(cond).select(*cols)


def stg_faceit_matches(cat: Catalog) -> DataFrame:
    return _match_stage(raw.raw_matches(cat, "faceit"), "faceit", False, False)


def stg_pandascore_matches(cat: Catalog) -> DataFrame:
    return _match_stage(raw.raw_matches(cat, "pandascore"), "pandascore", False, False)


def stg_csapi_matches(cat: Catalog) -> DataFrame:
    return _match_stage(raw.raw_matches(cat, "csapi"), "csapi", True, True)


def _player_stage(df: DataFrame, source: str, has_rating: bool, need_match: bool) -> DataFrame:
    cond = F.col("player_id").isNotNull()
    if need_match:
        cond = cond & F.col("match_id").isNotNull()
    cols = []
    for c in PLAYER_COLS:
        if c == "source":
            cols.append(F.lit(source).alias("source"))
        elif c == "rating" and not has_rating:
            cols.append(_null("double", "rating"))
        elif c in ("kills", "deaths"):
            # bigint for two providers, double for the third: the union is double
            cols.append(F.col(c).cast("double").alias(c))
        else:
            cols.append(F.col(c))
    return df.filter(cond).select(*cols)


def stg_faceit_players(cat: Catalog) -> DataFrame:
    return _player_stage(raw.raw_faceit_players(cat), "faceit", False, False)


def stg_pandascore_players(cat: Catalog) -> DataFrame:
    return _player_stage(raw.raw_pandascore_players(cat), "pandascore", False, False)


def stg_csapi_player_stats(cat: Catalog) -> DataFrame:
    return _player_stage(raw.raw_csapi_player_stats(cat), "csapi", True, True)


def stg_csapi_team_rankings(cat: Catalog) -> DataFrame:
    r = raw.raw_csapi_team_rankings(cat)
    return (r.filter(F.col("team_id").isNotNull() & F.col("world_ranking").isNotNull())
            .select("team_id", F.lit("csapi").alias("source"), "name", "region", "world_ranking", "vrs_points",
                    "rank_diff", "points_diff", "ranking_date", "ingested_at"))


def stg_liquipedia_teams(cat: Catalog) -> DataFrame:
    r = raw.raw_liquipedia_teams(cat)
    return (r.filter(F.col("team_id").isNotNull())
            .select("team_id", F.lit("liquipedia").alias("source"), "name", "region", "world_ranking",
                    "ingested_at"))


def stg_valve_team_regions(cat: Catalog) -> DataFrame:
    r = raw.raw_valve_team_regions(cat)
    return (r.filter(F.col("snapshot_date").isNotNull() & F.col("normalized_team_name").isNotNull()
                     & F.col("region").isNotNull())
            .select("snapshot_date", F.lit("valve").alias("source"), "team_name", "normalized_team_name",
                    "region", "regional_rank", "global_rank", "points", "roster", "detail_path"))


def _lenient_ts(c: str):
    return F.try_to_timestamp(F.col(c)).cast("timestamp_ntz")


def stg_hltv_round_history(cat: Catalog) -> DataFrame:
    r = raw.raw_hltv_round_history(cat)
    cond = (F.col("map_stats_id").isNotNull() & F.col("round_number").isNotNull()
            & F.col("winner_team_id").isNotNull() & F.col("team1_id").isNotNull() & F.col("team2_id").isNotNull())
    return r.filter(cond).select(
        "source", "map_stats_id", "match_id", "event_id", "event_name", "map_name",
        _lenient_ts("played_at").alias("played_at"),
        F.col("round_number").cast("int").alias("round_number"),
        "t_team_id", "t_team_name", "ct_team_id", "ct_team_name", "winner_side", "winner_team_id",
        "winner_team_name", "team1_id", "team1_name", "team2_id", "team2_name",
        F.col("score_team1_after").cast("int").alias("score_team1_after"),
        F.col("score_team2_after").cast("int").alias("score_team2_after"),
        "reported_score", "round_outcome",
        F.col("is_overtime").cast("boolean").alias("is_overtime"),
        _lenient_ts("ingested_at").alias("ingested_at"),
    )


# --------------------------------------------------------------------------- intermediate

def int_matches_unioned(cat: Catalog) -> DataFrame:
    """All match sources, no dedupe (the fact keeps ``source`` in its grain)."""
    parts = [stg_faceit_matches(cat), stg_pandascore_matches(cat), stg_csapi_matches(cat)]
    return reduce(DataFrame.unionByName, parts)


def staged_matches(rows: DataFrame) -> DataFrame:
    """Raw match rows of any provider as ``int_matches_unioned`` has them, in one pass (a load's micro-batch)."""
    csapi = F.col("source") == "csapi"
    teams = F.col("team_a_id").isNotNull() & F.col("team_b_id").isNotNull()
    known = F.col("source").isin("faceit", "pandascore", "csapi") & F.col("match_id").isNotNull() & (~csapi | teams)
    ranks = [F.when(csapi, F.col(c)).cast("bigint").alias(c) for c in MATCH_COLS[10:]]
    return rows.where(known).select(*MATCH_COLS[:10], *ranks)


def players_unioned_raw(cat: Catalog) -> DataFrame:
    parts = [stg_faceit_players(cat), stg_pandascore_players(cat), stg_csapi_player_stats(cat)]
    return reduce(DataFrame.unionByName, parts)


def player_grain() -> list[str | Column]:
    return ["player_id", F.coalesce(F.col("match_id"), F.lit(PROFILE_KEY))]


def first_provider() -> list[Column]:
    return [-source_priority("source", PLAYER_SOURCE_PRIORITY, 5)]


def int_players_unioned(cat: Catalog) -> DataFrame:
    """One row per (player, match), or per player for profile rows; provider
    priority faceit < pandascore < csapi, then the whole row as tie-break."""
    return cat.memo("int_players_unioned", lambda c: keep_first(players_unioned_raw(c), player_grain(), first_provider()))
