"""Registered queries for the payload normalisers and text parsers (section 2.3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import normalize_team_name, round_side, score_pair
from ..operators import normalize as N
from ..sources import payloads as P
from ..sources import raw_io
from ..sources import standins as raw
from ..sources.tables import Catalog
from . import core, staging as stg
from .registry import query

ROUNDS_LOADED_AT = "2026-05-04T00:00:00"


def _rounds(cat: Catalog) -> DataFrame:
    return cat.memo("norm_rounds", lambda c: N.hltv_rounds(P.hltv_map_docs(c), ROUNDS_LOADED_AT))


@query("norm_match_json")
def q_norm_match_json(cat: Catalog) -> DataFrame:
    """NRM-01: FACEIT match documents -> canonical matches."""
    return N.faceit_matches(P.faceit_match_docs(cat))


@query("norm_match_array")
def q_norm_match_array(cat: Catalog) -> DataFrame:
    """NRM-03 / SCL-21: PandaScore documents, ids and scores by array position."""
    return N.pandascore_matches(P.pandascore_match_docs(cat))


@query("norm_rankings")
def q_norm_rankings(cat: Catalog) -> DataFrame:
    """NRM-07 / NRM-23: ranking snapshot documents -> one row per (date, team)."""
    return N.ranking_rows(P.ranking_snapshot_docs(cat))


@query("norm_nested_explode")
def q_norm_nested_explode(cat: Catalog) -> DataFrame:
    """NRM-02: rounds[] -> teams[] -> players[] of FACEIT stats documents."""
    return N.faceit_stat_players(P.faceit_stats_docs(cat))


@query("norm_rounds")
def q_norm_rounds(cat: Catalog) -> DataFrame:
    """NRM-10: map documents -> 25-column round rows (invalid documents rejected)."""
    return _rounds(cat)


@query("running_score")
def q_running_score(cat: Catalog) -> DataFrame:
    """NRM-10e / WIN-06: running score with reported-score overrides."""
    return _rounds(cat).select("map_stats_id", "round_number", "score_team1_after", "score_team2_after")


@query("round_side_assignment")
def q_round_side_assignment(cat: Catalog) -> DataFrame:
    """NRM-10c: team1's side per round from start / swapped / overtime-half sides."""
    return _rounds(cat).select(F.col("map_stats_id").cast("bigint").alias("map_id"), "round_number",
                               F.when(F.col("ct_team_id") == F.col("team1_id"), "ct").otherwise("t").alias("team1_side"))


@query("round_side")
def q_round_side(cat: Catalog) -> DataFrame:
    """NRM-10a: outcome text -> winning side."""
    r = raw.raw_hltv_round_history(cat)
    return r.select("map_stats_id", "round_number", "round_outcome", round_side("round_outcome").alias("side"))


@query("score_parse")
def q_score_parse(cat: Catalog) -> DataFrame:
    """NRM-10d: "a-b" text -> two integers, null on anything else."""
    r = raw.raw_hltv_round_history(cat).select(
        "map_stats_id", "round_number", F.coalesce("reported_score", "round_outcome").alias("text"))
    a, b = score_pair("text")
    return r.select("map_stats_id", "round_number", "text", a.alias("score_1"), b.alias("score_2"))


@query("reject_invalid_groups")
def q_reject_invalid_groups(cat: Catalog) -> DataFrame:
    """NRM-10h: per map document, whether it survived (one bad round drops the map)."""
    docs = N.parsed(P.hltv_map_docs(cat).select("doc"), N.HLTV_MAP).select(
        F.col("d.id").cast("string").alias("map_stats_id"), F.size("d.roundHistory").alias("rounds"))
    kept = _rounds(cat).select("map_stats_id").distinct().withColumn("kept", F.lit(True))
    return docs.join(kept, "map_stats_id", "left").select(
        "map_stats_id", "rounds", F.coalesce("kept", F.lit(False)).alias("kept"))


@query("norm_player_stats")
def q_norm_player_stats(cat: Catalog) -> DataFrame:
    """NRM-09: statistics documents of matches -> player rows with team fallback and kd ratio."""
    return N.csapi_player_stats(P.csapi_stats_docs(cat))


@query("start_sides")
def q_start_sides(cat: Catalog) -> DataFrame:
    """NRM-19: start sides per map and per overtime half from the round list."""
    return N.start_sides(P.hltv_map_docs(cat, malformed=False))


@query("batch_summary")
def q_batch_summary(cat: Catalog) -> DataFrame:
    """SRC-07: per batch (event) documents scanned, valid maps, skipped, rows."""
    docs = P.hltv_map_docs(cat).groupBy("batch_id").agg(F.count(F.lit(1)).alias("scanned"))
    rows = _rounds(cat).groupBy(F.concat(F.lit("e"), F.col("event_id")).alias("batch_id")).agg(
        F.count_distinct("map_stats_id").alias("valid"), F.count(F.lit(1)).alias("rows"))
    j = docs.join(rows, "batch_id", "left")
    return j.select("batch_id", "scanned", F.coalesce("valid", F.lit(0)).alias("valid"),
                    F.greatest(F.col("scanned") - F.coalesce("valid", F.lit(0)), F.lit(0)).alias("skipped"),
                    F.coalesce("rows", F.lit(0)).alias("rows"))


@query("entity_counts")
def q_entity_counts(cat: Catalog) -> DataFrame:
    """NRM-06: documents per (source, entity), and Liquipedia's valid records, each from one pass over the stacked documents."""
    pages = P.liquipedia_docs(cat)
    docs = reduce(DataFrame.unionByName, [
        P.faceit_match_docs(cat), P.pandascore_match_docs(cat), P.ranking_snapshot_docs(cat),
        P.faceit_stats_docs(cat), P.hltv_map_docs(cat, malformed=False).drop("batch_id"), P.cached_match_docs(cat), pages])
    documents = docs.groupBy("source", "entity").agg(F.count(F.lit(1)).alias("documents"))
    records = N.liquipedia_records(pages).groupBy(F.lit("liquipedia").alias("source"), "entity").agg(F.count(F.lit(1)).alias("records"))
    return documents.join(records, ["source", "entity"], "left")


@query("norm_liquipedia_players")
def q_norm_liquipedia_players(cat: Catalog) -> DataFrame:
    """NRM-05: Liquipedia player records -> canonical players."""
    return N.liquipedia_players(N.liquipedia_records(P.liquipedia_docs(cat)), ROUNDS_LOADED_AT)


@query("norm_liquipedia_matches")
def q_norm_liquipedia_matches(cat: Catalog) -> DataFrame:
    """NRM-05: Liquipedia match records -> canonical matches."""
    return N.liquipedia_matches(N.liquipedia_records(P.liquipedia_docs(cat)))


@query("liquipedia_placements")
def q_liquipedia_placements(cat: Catalog) -> DataFrame:
    """NRM-06: placements with their tournaments, from the same pages."""
    return N.liquipedia_placements(N.liquipedia_records(P.liquipedia_docs(cat)))


@query("side_stats_flatten")
def q_side_stats_flatten(cat: Catalog) -> DataFrame:
    """NRM-16: player statistics per map, team and side of cached match documents."""
    return N.side_players(P.cached_match_docs(cat))


@query("match_player_stats")
def q_match_player_stats(cat: Catalog) -> DataFrame:
    """NRM-17: player statistics over the whole match of cached match documents."""
    return N.match_players(P.cached_match_docs(cat))


def _standings(cat: Catalog) -> DataFrame:
    return cat.memo("standings_rows", lambda c: N.pipe_table_rows(P.standings_lines(c)))


@query("parse_pipe_table")
def q_parse_pipe_table(cat: Catalog) -> DataFrame:
    """NRM-11: markdown standings -> rows."""
    return _standings(cat)


@query("attach_first_rank")
def q_attach_first_rank(cat: Catalog) -> DataFrame:
    """NRM-12: the global standings' rank of each regional row, by snapshot and first line of the normalised name."""
    ranks = N.global_ranks(P.global_standings_lines(cat))
    return N.attach_global_rank(_standings(cat), ranks).select(
        "snapshot_date", "region", "team_name", "normalized_team_name", "regional_rank", "global_rank", "points")


@query("normalize_name")
def q_normalize_name(cat: Catalog) -> DataFrame:
    """NRM-13 / SCL-10: team-name normalisation over every provider's names."""
    names = (raw.raw_csapi_team_rankings(cat).select(F.lit("csapi").alias("source"), F.col("name"))
             .unionByName(raw.raw_liquipedia_teams(cat).select(F.lit("liquipedia").alias("source"), F.col("name")))
             .unionByName(raw.raw_valve_team_regions(cat).select(F.lit("valve").alias("source"),
                                                                 F.col("team_name").alias("name"))))
    return names.distinct().select("source", "name", normalize_team_name("name").alias("normalized"))


@query("stat_cell_parse")
def q_stat_cell_parse(cat: Catalog) -> DataFrame:
    """NRM-15: stat cells ("33-32", "0 : 1", "12 (3)", "85%", junk) -> numbers."""
    p = stg.stg_csapi_player_stats(cat).select("player_id", "match_id", "kills", "deaths", "kast")
    k, d = F.col("kills").cast("bigint").cast("string"), F.col("deaths").cast("bigint").cast("string")
    cells = F.explode(F.array(
        F.struct(F.lit("kd").alias("kind"), F.concat(k, F.lit("-"), d).alias("cell")),
        F.struct(F.lit("colon").alias("kind"), F.concat(k, F.lit(" : "), d).alias("cell")),
        F.struct(F.lit("paren").alias("kind"), F.concat(k, F.lit(" ("), (F.col("deaths") / 5).cast("bigint")
                                                        .cast("string"), F.lit(")")).alias("cell")),
        F.struct(F.lit("pct").alias("kind"), F.concat(F.floor("kast").cast("string"), F.lit("%")).alias("cell")),
        F.struct(F.lit("junk").alias("kind"), F.lit("n/a").alias("cell"))))
    t = p.select("player_id", "match_id", cells.alias("c")).select("player_id", "match_id", "c.kind", "c.cell")
    return N.stat_cells(t, "cell")


@query("half_scores")
def q_half_scores(cat: Catalog) -> DataFrame:
    """NRM-20: "(16 : 14) ( 7 : 8 ) ..." -> half scores (first pair dropped when it is the total)."""
    r = stg.stg_hltv_round_history(cat)
    m = r.groupBy("map_stats_id").agg(
        F.max("score_team1_after").alias("f1"), F.max("score_team2_after").alias("f2"),
        F.max(F.when(F.col("round_number") == 12, F.col("score_team1_after"))).alias("h1"),
        F.max(F.when(F.col("round_number") == 12, F.col("score_team2_after"))).alias("h2"))
    s = lambda c: F.col(c).cast("string")
    text = F.when(F.col("h1").isNull(), F.concat(F.lit("("), s("f1"), F.lit(" : "), s("f2"), F.lit(")"))).otherwise(
        F.concat(F.lit("("), s("f1"), F.lit(" : "), s("f2"), F.lit(") ( "), s("h1"), F.lit(" : "), s("h2"),
                 F.lit(" ) ( "), (F.col("f1") - F.col("h1")).cast("string"), F.lit(" : "),
                 (F.col("f2") - F.col("h2")).cast("string"), F.lit(" )")))
    h = N.half_scores(m.select("map_stats_id", text.alias("halves_text")), "halves_text")
    return h.select("map_stats_id", F.posexplode("halves").alias("half", "x")).select(
        "map_stats_id", "half", "x.team1_rounds", "x.team2_rounds")


@query("series_result")
def q_series_result(cat: Catalog) -> DataFrame:
    """NRM-21: maps won per side and series winner per (match, source)."""
    f = core.table(cat, "fact_matches")
    a, b = F.coalesce("score_a", F.lit(0)), F.coalesce("score_b", F.lit(0))
    g = f.groupBy("match_id", "source").agg(F.count_if(a > b).alias("team1_maps"), F.count_if(b > a).alias("team2_maps"))
    return g.withColumn("winner", F.when(F.col("team1_maps") > F.col("team2_maps"), F.lit(1))
                        .when(F.col("team2_maps") > F.col("team1_maps"), F.lit(2)))


@query("norm_match_series")
def q_norm_match_series(cat: Catalog) -> DataFrame:
    """NRM-08 / NRM-22: CS API series documents -> canonical matches with format."""
    return N.csapi_matches(P.csapi_match_docs(cat))


@query("contract_validation")
def q_contract_validation(cat: Catalog) -> DataFrame:
    """NRM-14: canonical matches of two providers checked against the contract."""
    from .. import schemas
    rows = N.faceit_matches(P.faceit_match_docs(cat)).unionByName(N.pandascore_matches(P.pandascore_match_docs(cat)))
    allowed = tuple(f.name for f in schemas.RAW_MATCHES.fields)
    checked = N.contract_split(rows, schemas.CANONICAL_MATCH_REQUIRED, allowed)
    return checked.groupBy("source", "contract_ok").agg(F.count(F.lit(1)).alias("n"))


@query("scan_documents")
def q_scan_documents(cat: Catalog) -> DataFrame:
    """SRC-04 / SRC-06: a directory with one JSON document per file; every file with its verdict, by path. Only
    valid documents count their rounds."""
    path = cat.stored("hltv_documents", lambda folder: P.write_document_files(cat, folder))
    files = N.judged_maps(raw_io.whole_files(cat.spark, path, "*.txt"))
    valid = F.col("verdict") == N.VALID
    return files.select(raw_io.file_name("file_path").alias("document"), "verdict",
                        F.when(valid, F.col("d.id")).alias("map_id"), F.when(valid, F.size("rounds")).otherwise(0).alias("rounds"))


@query("norm_players")
def q_norm_players(cat: Catalog) -> DataFrame:
    """NRM-04: PandaScore player objects -> canonical players."""
    return N.pandascore_players(P.pandascore_player_docs(cat))


@query("norm_teams")
def q_norm_teams(cat: Catalog) -> DataFrame:
    """NRM-05: Liquipedia team pages -> canonical teams."""
    return N.liquipedia_teams(N.liquipedia_records(P.liquipedia_docs(cat)))
