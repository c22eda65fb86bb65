"""Raw table contracts (explicit schemas; nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_MATCHES = _schema(
    ("match_id", S, False), ("team_a_id", S, False), ("team_b_id", S, False), ("winner_id", S, True),
    ("played_at", S, False), ("map_name", S, True), ("score_a", L, True), ("score_b", L, True),
    ("is_overtime", B, True), ("team_a_ranking", L, True), ("team_b_ranking", L, True), ("source", S, False))

RAW_CSAPI_TEAM_RANKINGS = _schema(
    ("team_id", S, False), ("source", S, False), ("name", S, False), ("region", S, True),
    ("world_ranking", L, False), ("vrs_points", L, True), ("rank_diff", L, True), ("points_diff", L, True),
    ("ranking_date", S, False), ("ingested_at", S, False))

RAW_LIQUIPEDIA_TEAMS = _schema(
    ("team_id", S, False), ("source", S, False), ("name", S, False), ("region", S, True),
    ("world_ranking", L, True), ("ingested_at", S, False))

RAW_VALVE_TEAM_REGIONS = _schema(
    ("snapshot_date", S, False), ("team_name", S, False), ("normalized_team_name", S, False), ("region", S, False),
    ("regional_rank", L, False), ("global_rank", L, True), ("points", L, True), ("roster", S, True),
    ("detail_path", S, True), ("source", S, False))

RAW_HLTV_ROUND_HISTORY = _schema(
    ("source", S, False), ("map_stats_id", S, False), ("match_id", S, False), ("event_id", S, True),
    ("event_name", S, True), ("map_name", S, False), ("played_at", S, False), ("round_number", L, False),
    ("t_team_id", S, False), ("t_team_name", S, True), ("ct_team_id", S, False), ("ct_team_name", S, True),
    ("winner_side", S, False), ("winner_team_id", S, False), ("winner_team_name", S, True), ("team1_id", S, False),
    ("team1_name", S, False), ("team2_id", S, False), ("team2_name", S, False), ("score_team1_after", L, False),
    ("score_team2_after", L, False), ("reported_score", S, True), ("round_outcome", S, False),
    ("is_overtime", B, False), ("ingested_at", S, False))

CANONICAL_MATCH_REQUIRED = ("match_id", "source", "team_a_id", "team_b_id", "played_at")
