"""Payload normalisers: JSON / text records -> canonical rows, as column expressions.

Each function takes a DataFrame with a ``doc`` (JSON text) or ``line`` column
and returns canonical rows. Parsing is ``from_json`` with an explicit schema
(unknown fields are ignored, missing ones are null), nested arrays are
``explode``d, and per-record rules are ``when`` chains, so everything runs in
the JVM inside whole-stage code generation; no Python runs per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import normalize_team_name, round_side, score_pair

UNKNOWN = "unknown"
OVERTIME_SCORE = 15
REGULATION_ROUNDS = 24
HALF_ROUNDS = 12
OT_HALF_ROUNDS = 3

FACEIT_MATCH = ("match_id string, game string, region string, competition_name string, map string, "
                "teams struct<faction1: struct<faction_id: string>, faction2: struct<faction_id: string>>, "
                "results struct<winner: string, score: struct<faction1: int, faction2: int>>, finished_at bigint")
PANDASCORE_MATCH = ("id bigint, name string, status string, begin_at string, end_at string, map string, "
                    "winner struct<id: bigint, name: string>, "
                    "opponents array<struct<opponent: struct<id: bigint, name: string>>>, "
                    "results array<struct<score: int>>")
RANKING_SNAPSHOT = ("date string, url string, teams array<struct<rank: bigint, points: bigint, name: string, "
                    "id: string, region: string, players: array<string>>>")
FACEIT_STATS = ("match_id string, rounds array<struct<teams: array<struct<team_id: string, players: array<struct<"
                "player_id: string, nickname: string, country: string, skill_level: int, faceit_elo: int, "
                "player_stats: map<string, string>>>>>>>")
HLTV_MAP = ("id bigint, matchId bigint, map string, date bigint, team1 struct<id: bigint, name: string>, "
            "team2 struct<id: bigint, name: string>, event struct<id: bigint, name: string>, "
            "startSides struct<team1: string, team2: string>, "
            "overtimeStartSides array<struct<team1: string, team2: string>>, "
            "roundHistory array<struct<round: int, winner: int, outcome: string, score: string, "
            "isOvertime: boolean, tTeam: bigint, ctTeam: bigint>>")


def parsed(docs: DataFrame, schema: str, doc: str = "doc") -> DataFrame:
    """``docs`` with the JSON text of ``doc`` parsed once into the struct ``d``.

    The generator keeps the optimizer from copying ``from_json`` into every later filter
    and lambda that looks into the document (it merges projections, and pushes filters below them)."""
    rest = [F.col(c) for c in docs.columns if c != doc]
    return docs.select(*rest, F.explode(F.array(F.from_json(doc, schema))).alias("d"))


def _iso_date_from_seconds(c: Column) -> Column:
    return F.date_format(F.to_date(F.timestamp_seconds(c)), "yyyy-MM-dd")


def faceit_matches(docs: DataFrame) -> DataFrame:
    """FACEIT match -> canonical match."""
    d = parsed(docs, FACEIT_MATCH).select("d.*")
    a = F.coalesce(F.col("teams.faction1.faction_id"), F.lit(UNKNOWN))
    b = F.coalesce(F.col("teams.faction2.faction_id"), F.lit(UNKNOWN))
    sa, sb = F.col("results.score.faction1"), F.col("results.score.faction2")
    both = sa.isNotNull() & sb.isNotNull()
    w = F.col("results.winner")
    return d.select(
        F.col("match_id"), F.lit("faceit").alias("source"), a.alias("team_a_id"), b.alias("team_b_id"),
        F.when(w == "faction1", a).when(w == "faction2", b).alias("winner_id"),
        F.coalesce(_iso_date_from_seconds(F.col("finished_at")), F.lit(UNKNOWN)).alias("played_at"),
        F.col("map").alias("map_name"),
        F.when(both, sa.cast("bigint")).alias("score_a"), F.when(both, sb.cast("bigint")).alias("score_b"),
        F.when(both, (sa > OVERTIME_SCORE) & (sb > OVERTIME_SCORE)).alias("is_overtime"))


def pandascore_matches(docs: DataFrame) -> DataFrame:
    """PandaScore match -> canonical match (ids by array position)."""
    d = parsed(docs, PANDASCORE_MATCH).select("d.*")
    opp = lambda i: F.try_element_at("opponents", F.lit(i)).getField("opponent").getField("id")
    a = F.coalesce(opp(1).cast("string"), F.lit(UNKNOWN))
    b = F.coalesce(opp(2).cast("string"), F.lit(UNKNOWN))
    res = lambda i: F.try_element_at("results", F.lit(i)).getField("score")
    sa, sb = res(1), res(2)
    both = sa.isNotNull() & sb.isNotNull()
    return d.select(
        F.col("id").cast("string").alias("match_id"), F.lit("pandascore").alias("source"),
        a.alias("team_a_id"), b.alias("team_b_id"), F.col("winner.id").cast("string").alias("winner_id"),
        F.coalesce(F.substring("begin_at", 1, 10), F.lit(UNKNOWN)).alias("played_at"),
        F.col("map").alias("map_name"),
        F.when(both, sa.cast("bigint")).alias("score_a"), F.when(both, sb.cast("bigint")).alias("score_b"),
        F.when(both, (sa > OVERTIME_SCORE) & (sb > OVERTIME_SCORE)).alias("is_overtime"))


def ranking_rows(docs: DataFrame) -> DataFrame:
    """Ranking snapshot -> one row per team with the snapshot date injected."""
    d = parsed(docs, RANKING_SNAPSHOT)
    return d.select(F.col("d.date").alias("ranking_date"), F.explode("d.teams").alias("t")).select(
        F.col("t.id").alias("team_id"), F.col("t.name").alias("name"), F.col("t.rank").alias("world_ranking"),
        F.col("t.points").alias("vrs_points"), F.lit(None).cast("string").alias("region"), "ranking_date")


def faceit_stat_players(docs: DataFrame) -> DataFrame:
    """rounds[] -> teams[] -> players[]: one row per player; stat columns stay
    null as in the reference's default (the profile model keeps no stats)."""
    d = parsed(docs, FACEIT_STATS).select("d.match_id", F.explode("d.rounds").alias("r"))
    t = d.select("match_id", F.explode("r.teams").alias("t"))
    p = t.select("match_id", F.col("t.team_id").alias("team_id"), F.explode("t.players").alias("p"))
    return p.select(F.col("p.player_id").alias("player_id"), F.lit("faceit").alias("source"),
                    F.col("p.nickname").alias("display_name"), "team_id", F.col("p.country").alias("nationality"),
                    F.lit(None).cast("bigint").alias("kills"), F.lit(None).cast("bigint").alias("deaths"),
                    F.col("p.faceit_elo").cast("bigint").alias("elo"), "match_id")


def _side_for(assign: Column, team: str) -> Column:
    return F.lower(F.trim(assign.getField(team)))


def _round(r: Column, pos: Column) -> Column:
    """One entry of a round list with its sides, winner and validity. Refers to
    the document ``d``; everything is an expression inside one row."""
    t1, t2, start = F.col("d.team1.id"), F.col("d.team2.id"), F.col("d.startSides")
    rn = F.when(r["round"] != 0, r["round"]).otherwise(pos + 1)  # a missing or zero number counts from the place
    rn = F.coalesce(rn, pos + 1)
    swapped = F.struct(start.getField("team2").alias("team1"), start.getField("team1").alias("team2"))
    half = F.get(F.col("d.overtimeStartSides"), F.floor((rn - (REGULATION_ROUNDS + 1)) / OT_HALF_ROUNDS).cast("int"))
    side1 = _side_for(F.when(rn <= HALF_ROUNDS, start).when(rn <= REGULATION_ROUNDS, swapped).otherwise(half), "team1")
    won_by = round_side(r["outcome"])
    explicit = r["tTeam"].isNotNull() & r["ctTeam"].isNotNull()
    t_id = F.when(explicit, r["tTeam"]).when(side1 == "t", t1).when(side1 == "ct", t2)
    ct_id = F.when(explicit, r["ctTeam"]).when(side1 == "ct", t1).when(side1 == "t", t2)
    winner = (F.when(r["winner"] == 1, t1).when(r["winner"] == 2, t2)
              .when(explicit & (won_by == "ct"), r["ctTeam"]).when(explicit & (won_by == "t"), r["tTeam"]))
    a, b = score_pair(r["score"])
    # A score without a dash counts as absent; one with a dash must be two integers.
    bad_score = F.coalesce(r["score"].contains("-"), F.lit(False)) & (a.isNull() | b.isNull())
    valid = (r["outcome"].isNotNull() & t_id.isNotNull() & ct_id.isNotNull() & ((winner == t1) | (winner == t2))
             & (explicit | side1.isin("t", "ct")) & (~explicit | won_by.isNotNull()) & ~bad_score)
    side = F.when(explicit, won_by).when(winner == t_id, F.lit("t")).otherwise(F.lit("ct"))
    return F.struct(rn.alias("round_number"), t_id.alias("t_id"), ct_id.alias("ct_id"), winner.alias("winner_id"),
                    side.alias("side"), a.alias("a"), b.alias("b"), r["score"].alias("score"),
                    r["outcome"].alias("outcome"), F.coalesce(r["isOvertime"], rn > REGULATION_ROUNDS).alias("is_overtime"),
                    F.coalesce(valid, F.lit(False)).alias("valid"))


MALFORMED, INVALID, EMPTY, VALID = "malformed", "invalid", "empty", "valid"


def _verdict(d: Column, rounds: Column) -> Column:
    sound = F.coalesce(F.forall(rounds, lambda x: x["valid"]), F.lit(True))
    for c in (d["date"], d["matchId"], d["map"], d["team1"]["id"], d["team2"]["id"]):
        sound = sound & c.isNotNull()
    return F.when(d.isNull() | d["_corrupt_record"].isNotNull(), MALFORMED).when(~sound, INVALID) \
        .when(F.coalesce(F.size(rounds), F.lit(0)) <= 0, EMPTY).otherwise(VALID)


def judged_maps(docs: DataFrame, doc: str = "doc", only: str | None = None) -> DataFrame:
    """``docs`` with the parsed map document ``d``, its ``rounds`` with sides and winners, and a ``verdict``:
    malformed (no JSON document, or a value of another type), invalid (no date, match id, map or
    teams, or an invalid round), empty (no rounds) or valid; all, or those of ``only`` one verdict.

    The generator makes the rounds and judges them once, as ``parsed`` parses once."""
    d = parsed(docs, f"{HLTV_MAP}, _corrupt_record string", doc)
    made = F.array(F.struct(F.col("d"), F.transform("d.roundHistory", _round).alias("rounds")))
    judged = F.transform(made, lambda x: F.struct(x["d"].alias("d"), x["rounds"].alias("rounds"), _verdict(x["d"], x["rounds"]).alias("verdict")))
    if only is not None:
        judged = F.filter(judged, lambda x: x["verdict"] == only)
    rest = [c for c in d.columns if c != "d"]
    return d.select(*rest, F.explode(judged).alias("j")).select(*rest, "j.d", "j.rounds", "j.verdict")


def hltv_rounds(docs: DataFrame, ingested_at: str) -> DataFrame:
    """Map document -> one row per round (25 columns); a document with any
    invalid round, or without date, match id, map or teams, is dropped whole.

    Side per round: rounds 1-12 start sides, 13-24 swapped, overtime rounds
    the start sides of their 3-round half. Winner: 1/2, else by side. Score:
    a reported "a-b" overrides, otherwise the previous score plus the win.
    A document is judged by itself (array functions, no shuffle), so repeated
    documents neither mix their scores nor reject each other.
    """
    t1, t2 = F.col("d.team1.id"), F.col("d.team2.id")
    d = judged_maps(docs.select("doc"), only=VALID).select("d", "rounds")
    points = "array<struct<s1:bigint,s2:bigint>>"

    def score(acc: Column, x: Column) -> Column:
        both = x["a"].isNotNull() & x["b"].isNotNull()
        s1 = F.when(both, x["a"]).otherwise(acc["s1"] + (x["winner_id"] == t1).cast("bigint"))
        s2 = F.when(both, x["b"]).otherwise(acc["s2"] + (x["winner_id"] == t2).cast("bigint"))
        return F.struct(s1.alias("s1"), s2.alias("s2"),
                        F.concat(acc["all"], F.array(F.struct(s1.alias("s1"), s2.alias("s2")))).alias("all"))

    zero = F.struct(F.lit(0).cast("bigint").alias("s1"), F.lit(0).cast("bigint").alias("s2"),
                    F.array().cast(points).alias("all"))
    d = d.select("d", "rounds", F.aggregate("rounds", zero, score, lambda acc: acc["all"]).alias("scores"))
    d = d.select("d", F.explode(F.arrays_zip("rounds", "scores")).alias("z")).select("d", "z.rounds.*", "z.scores.*")
    name_of = lambda i: F.when(F.col(i) == t1, F.col("d.team1.name")).when(F.col(i) == t2, F.col("d.team2.name"))
    text = lambda c, n: F.col(c).cast("string").alias(n)
    return d.select(
        F.lit("hltv_unofficial").alias("source"), text("d.id", "map_stats_id"), text("d.matchId", "match_id"),
        text("d.event.id", "event_id"), F.col("d.event.name").alias("event_name"), F.col("d.map").alias("map_name"),
        F.date_format(F.to_date(F.timestamp_millis(F.col("d.date"))), "yyyy-MM-dd").alias("played_at"),
        F.col("round_number").cast("bigint").alias("round_number"),
        text("t_id", "t_team_id"), name_of("t_id").alias("t_team_name"),
        text("ct_id", "ct_team_id"), name_of("ct_id").alias("ct_team_name"), F.col("side").alias("winner_side"),
        text("winner_id", "winner_team_id"), name_of("winner_id").alias("winner_team_name"),
        text("d.team1.id", "team1_id"), F.col("d.team1.name").alias("team1_name"),
        text("d.team2.id", "team2_id"), F.col("d.team2.name").alias("team2_name"),
        F.col("s1").alias("score_team1_after"), F.col("s2").alias("score_team2_after"),
        F.col("score").alias("reported_score"), F.col("outcome").alias("round_outcome"), "is_overtime",
        F.lit(ingested_at).alias("ingested_at"))


CSAPI_STATS_PLAYER = "struct<id: bigint, name: string, k: double, d: double, swing: double, adr: double, kast: double, rating: double>"
CSAPI_STATS_TEAM = f"struct<id: bigint, name: string, players: array<{CSAPI_STATS_PLAYER}>>"
CSAPI_STATS = ("match struct<id: string, date: string, team1: struct<id: bigint, name: string>, team2: struct<id: bigint, "
               f"name: string>>, stats array<struct<id: bigint, name: string, team1: {CSAPI_STATS_TEAM}, "
               f"team2: {CSAPI_STATS_TEAM}>>")


def csapi_player_stats(docs: DataFrame) -> DataFrame:
    """Statistics document of a match -> one row per player of both teams, from the
    first block with id 0 or named "all" (any case). The block's team id and name
    count, else (absent, or 0 / empty) the match's. Documents without such a block, match id or
    date give no rows; entries that aren't players (null) and players that lack a
    required value are left out."""
    d = parsed(docs.select("doc"), CSAPI_STATS).where(
        F.col("d.match.id").isNotNull() & F.col("d.match.date").isNotNull())
    whole = F.filter("d.stats", lambda b: (b["id"] == 0) | (F.lower(F.coalesce(b["name"], F.lit(""))) == "all"))
    d = d.select("d.match", F.get(whole, F.lit(0)).alias("block")).where("block is not null")

    def side(team: str) -> Column:
        own, match = F.col(f"block.{team}"), F.col(f"match.{team}")
        return F.struct(F.coalesce(F.nullif(own["id"], F.lit(0).cast("bigint")), match["id"]).alias("team_id"),
                        F.coalesce(F.nullif(own["name"], F.lit("")), match["name"]).alias("team_name"),
                        own["players"].alias("players"))

    t = d.select("match", F.explode(F.array(side("team1"), side("team2"))).alias("t"))
    p = t.select("match", "t.team_id", "t.team_name", F.explode("t.players").alias("p"))
    p = p.where(F.forall(F.array(*[F.col(f"p.{c}").cast("string") for c in (
        "id", "name", "k", "d", "swing", "adr", "kast", "rating")]), lambda x: x.isNotNull()))
    null = lambda t, n: F.lit(None).cast(t).alias(n)
    return p.select(
        F.col("p.id").cast("string").alias("player_id"), F.lit("csapi").alias("source"), F.col("p.name").alias("display_name"),
        F.col("team_id").cast("string").alias("team_id"), "team_name", null("string", "nationality"),
        F.col("p.k").alias("kills"), F.col("p.d").alias("deaths"), F.col("p.adr").alias("adr"),
        F.when(F.col("p.d") > 0, F.col("p.k") / F.col("p.d")).alias("kd_ratio"), F.col("p.kast").alias("kast"),
        F.col("p.rating").alias("rating"), F.col("p.swing").alias("swing"), F.lit(1).cast("bigint").alias("matches_played"),
        null("bigint", "elo"), F.col("match.id").alias("match_id"), F.col("match.date").alias("recorded_at"))


def start_sides(docs: DataFrame) -> DataFrame:
    """Start sides per map (regulation) and per 3-round overtime half, from the
    first round of the slice whose outcome has a known side and whose winner is 1 or 2."""
    d = parsed(docs.select("doc"), HLTV_MAP)
    r = d.select(F.col("d.id").alias("map_id"), F.explode("d.roundHistory").alias("r"))
    ot = F.coalesce(F.col("r.isOvertime"), F.col("r.round") > REGULATION_ROUNDS)
    r = r.select("map_id", "r.*", F.when(ot, F.floor((F.col("round") - (REGULATION_ROUNDS + 1)) / OT_HALF_ROUNDS))
                 .otherwise(F.lit(-1)).alias("slice"), round_side(F.col("outcome")).alias("side"))
    known = r.where(F.col("side").isNotNull() & F.col("winner").isin(1, 2))
    first = known.groupBy("map_id", "slice").agg(F.min_by(F.struct("winner", "side"), F.col("round")).alias("f"))
    win_side = F.upper(F.col("f.side"))
    lose_side = F.when(win_side == "CT", F.lit("T")).otherwise(F.lit("CT"))
    return first.select("map_id", "slice",
                        F.when(F.col("f.winner") == 1, win_side).otherwise(lose_side).alias("team1"),
                        F.when(F.col("f.winner") == 2, win_side).otherwise(lose_side).alias("team2"))


def _cells(line: Column) -> Column:
    """The trimmed cells of a pipe row; ``<br />`` and the outer pipes don't count."""
    bare = F.regexp_replace(F.trim(F.replace(line, F.lit("<br />"), F.lit(""))), r"^\|+|\|+$", "")
    return F.transform(F.split(bare, r"\|"), lambda c: F.trim(c))


def _number(cell: Column) -> Column:
    """"1,871" and "12." are numbers: only digits and minus signs count; null without a number."""
    return F.regexp_replace(cell, r"[^0-9-]+", "").try_cast("bigint")


def _table_cells(lines: DataFrame, least: int) -> DataFrame:
    """The data rows of markdown tables as ``cells``: pipe rows with ``least`` cells that aren't header or separator."""
    bare = F.trim(F.replace(F.col("line"), F.lit("<br />"), F.lit("")))
    t = lines.where(bare.startswith("|")).select(*[c for c in lines.columns if c != "line"], _cells(F.col("line")).alias("cells"))
    first = F.col("cells")[0]
    return t.where((F.size("cells") >= least) & ~first.rlike("^[:-]*$") & (F.lower(first) != "standing"))


def pipe_table_rows(lines: DataFrame) -> DataFrame:
    """Markdown standings lines -> (rank, points, team, roster, details). A row needs four
    cells, a rank and a name that has letters or digits; points may be missing."""
    link = F.regexp_extract(F.coalesce(F.try_element_at("cells", F.lit(5)), F.lit("")), r"(?i)\[details\]\(([^)]+)\)", 1)
    t = _table_cells(lines, 4)
    t = t.select(*[c for c in t.columns if c != "cells"], _number(F.col("cells")[0]).alias("regional_rank"),
                 _number(F.col("cells")[1]).alias("points"), F.col("cells")[2].alias("team_name"),
                 F.nullif(F.col("cells")[3], F.lit("")).alias("roster"), F.nullif(F.trim(link), F.lit("")).alias("detail_path"),
                 normalize_team_name(F.col("cells")[2]).alias("normalized_team_name"))
    return t.where(F.col("regional_rank").isNotNull() & (F.col("normalized_team_name") != ""))


def global_ranks(lines: DataFrame) -> DataFrame:
    """Global standings lines -> one rank per snapshot and normalised name, that of its first line."""
    t = _table_cells(lines, 3).select("snapshot_date", "line_no", _number(F.col("cells")[0]).alias("rank"),
                                      normalize_team_name(F.col("cells")[2]).alias("normalized_team_name"))
    return t.where(F.col("rank").isNotNull() & (F.col("normalized_team_name") != "")) \
        .groupBy("snapshot_date", "normalized_team_name").agg(F.min_by("rank", "line_no").alias("global_rank"))


def attach_global_rank(regional: DataFrame, ranks: DataFrame) -> DataFrame:
    """Regional standings rows with the global rank of their name in the same snapshot."""
    return regional.join(ranks, ["snapshot_date", "normalized_team_name"], "left")


def stat_cells(df: DataFrame, col: str) -> DataFrame:
    """Stat-cell text -> numbers: "33-32" and "0 : 1" pairs, "12 (3)" main and
    bracket value, "85.7%" percent; null on anything else."""
    c = F.col(col)
    pair = r"^\s*(-?\d+(?:\.\d+)?)\s*[-:]\s*(-?\d+(?:\.\d+)?)\s*$"
    paren = r"^\s*(-?\d+(?:\.\d+)?)\s*(?:\(\s*(-?\d+(?:\.\d+)?)\s*\))?\s*$"
    pct = r"(-?\d+(?:\.\d+)?)\s*%"
    is_pair = c.rlike(pair)
    is_paren = c.rlike(paren)
    return df.select(
        "*",
        F.when(is_pair, F.regexp_extract(c, pair, 1).try_cast("double")).alias("pair_left"),
        F.when(is_pair, F.regexp_extract(c, pair, 2).try_cast("double")).alias("pair_right"),
        F.when(is_paren, F.regexp_extract(c, paren, 1).try_cast("double")).alias("main_value"),
        F.when(is_paren, F.nullif(F.regexp_extract(c, paren, 2), F.lit("")).try_cast("double")).alias("paren_value"),
        F.when(c.rlike(pct), F.regexp_extract(c, pct, 1).try_cast("double")).alias("percent"))


def half_scores(df: DataFrame, col: str) -> DataFrame:
    """"(16 : 14) ( 7 : 8 ) ..." -> array of (team1, team2) half scores; the
    first pair is the total and is dropped when more than two pairs are present."""
    pairs = F.regexp_extract_all(F.col(col), F.lit(r"(\d+\s*:\s*\d+)"), 1)
    kept = F.when(F.size(pairs) > 2, F.slice(pairs, F.lit(2), F.size(pairs) - 1)).otherwise(pairs)
    as_struct = F.transform(kept, lambda p: F.struct(
        F.trim(F.split(p, ":")[0]).try_cast("int").alias("team1_rounds"),
        F.trim(F.split(p, ":")[1]).try_cast("int").alias("team2_rounds")))
    return df.select("*", as_struct.alias("halves"))


CSAPI_MATCH = ("id bigint, team1 struct<id: bigint, name: string, score: int, rank: int>, "
               "team2 struct<id: bigint, name: string, score: int, rank: int>, maps array<struct<name: string>>, "
               "best_of int, format string, date string, event string, winner struct<id: bigint, name: string>")


def csapi_matches(docs: DataFrame) -> DataFrame:
    """CS API series -> canonical match: map and overtime are not known at
    series level (null); rankings are kept from the payload; format is
    "Best of N" -> boN, else taken from the number of maps."""
    d = parsed(docs, CSAPI_MATCH).select("d.*")
    n = F.regexp_extract(F.coalesce(F.col("format"), F.lit("")), r"(?i)best of (\d+)", 1)
    fmt = F.when(n != "", F.concat(F.lit("bo"), n)).otherwise(F.concat(F.lit("bo"), F.size("maps").cast("string")))
    return d.select(
        F.col("id").cast("string").alias("match_id"), F.lit("csapi").alias("source"),
        F.col("team1.id").cast("string").alias("team_a_id"), F.col("team2.id").cast("string").alias("team_b_id"),
        F.col("winner.id").cast("string").alias("winner_id"), F.col("date").alias("played_at"),
        F.lit(None).cast("string").alias("map_name"),
        F.col("team1.score").cast("bigint").alias("score_a"), F.col("team2.score").cast("bigint").alias("score_b"),
        F.lit(None).cast("boolean").alias("is_overtime"),
        F.col("team1.rank").cast("bigint").alias("team_a_ranking"), F.col("team2.rank").cast("bigint").alias("team_b_ranking"),
        fmt.alias("series_format"))


def contract_split(df: DataFrame, required: tuple[str, ...], allowed: tuple[str, ...]) -> DataFrame:
    """Mark rows that break the contract: a required field null, or a column
    outside the contract (then every row fails). Adds ``contract_ok``."""
    extra = sorted(set(df.columns) - set(allowed))
    ok = F.lit(not extra)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.withColumn("contract_ok", ok)


CACHED_SIDE_PLAYER = (
    "struct<playerId: bigint, nickname: string, country: string, openingKills: double, openingDeaths: double, "
    "ecoOpeningKills: double, ecoOpeningDeaths: double, multiKillRounds: double, kast: double, ecoKast: double, "
    "clutchesWon: double, kills: double, headshots: double, ecoKills: double, ecoHeadshots: double, assists: double, "
    "flashAssists: double, deaths: double, tradedDeaths: double, ecoDeaths: double, ecoTradedDeaths: double, adr: double, "
    "ecoAdr: double, swing: double, rating: double>")
CACHED_MATCH_PLAYER = (
    "struct<playerId: bigint, nickname: string, country: string, kills: double, deaths: double, ecoKills: double, "
    "ecoDeaths: double, swing: double, adr: double, ecoAdr: double, kast: double, ecoKast: double, rating: double>")
_SIDES = f"struct<combined: array<{CACHED_SIDE_PLAYER}>, t: array<{CACHED_SIDE_PLAYER}>, ct: array<{CACHED_SIDE_PLAYER}>>"
CACHED_MATCH = (f"id bigint, maps array<struct<mapstatsId: bigint, map: string, error: string, "
                f"playerStats: struct<team1: {_SIDES}, team2: {_SIDES}>>>, "
                f"matchAggregateStats struct<team1: array<{CACHED_MATCH_PLAYER}>, team2: array<{CACHED_MATCH_PLAYER}>>")
NO_COUNT_IS_ZERO = ("multiKillRounds", "clutchesWon")


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def _player_columns(player: str, zero: tuple[str, ...] = ()) -> list[Column]:
    """The fields of a player struct ``p`` under the names of the contract."""
    names = [f.split(":")[0].strip() for f in player[len("struct<"):-1].split(",")]
    out = []
    for n in names:
        c = F.col(f"p.{n}")
        if n == "playerId":
            c = c.cast("string")
        out.append((F.coalesce(c, F.lit(0.0)) if n in zero else c).alias(_snake(n)))
    return out


def side_players(docs: DataFrame) -> DataFrame:
    """Cached match documents -> one row per map, team, side and player (25 fields). A map that was recorded as an
    error, or whose statistics have another shape, gives no rows; the other maps do. Players need an id."""
    m = parsed(docs.select("doc"), CACHED_MATCH).select(F.col("d.id").alias("match_id"), F.explode("d.maps").alias("m")) \
        .where(F.col("m.error").isNull() & F.col("m.mapstatsId").isNotNull())
    per_side = F.explode(F.array(*[F.struct(F.lit(team).alias("team"), F.lit(side).alias("side"), F.col(f"m.playerStats.{team}.{side}").alias("players"))
                                   for team in ("team1", "team2") for side in ("combined", "t", "ct")])).alias("s")
    p = m.select("match_id", "m.mapstatsId", "m.map", per_side).select(
        "match_id", "mapstatsId", "map", "s.team", "s.side", F.explode("s.players").alias("p")).where(F.col("p.playerId").isNotNull())
    return p.select(F.col("match_id").cast("string").alias("match_id"), F.col("mapstatsId").cast("string").alias("map_stats_id"),
                    F.col("map").alias("map_name"), "team", "side", *_player_columns(CACHED_SIDE_PLAYER, NO_COUNT_IS_ZERO))


def match_players(docs: DataFrame) -> DataFrame:
    """Cached match documents -> one row per team and player over the whole match. Players need an id."""
    d = parsed(docs.select("doc"), CACHED_MATCH)
    per_team = F.explode(F.array(*[F.struct(F.lit(team).alias("team"), F.col(f"d.matchAggregateStats.{team}").alias("players"))
                                   for team in ("team1", "team2")])).alias("t")
    p = d.select(F.col("d.id").cast("string").alias("match_id"), per_team).select("match_id", "t.team", F.explode("t.players").alias("p")) \
        .where(F.col("p.playerId").isNotNull())
    return p.select("match_id", "team", *_player_columns(CACHED_MATCH_PLAYER))


PANDASCORE_PLAYER = ("id bigint, name string, nationality string, current_team struct<id: bigint, name: string>, "
                     "match_id string, recorded_at string")
LIQUIPEDIA_RESULT = "result array<map<string, string>>"  # whatever a value's type, it arrives as text
# Required fields of a record, by entity.
LIQUIPEDIA_REQUIRED = {"team": ("pagename", "name"), "player": ("pagename", "id"), "match": ("match2id",),
                       "tournament": ("pagename", "name"), "placement": ("pagename",)}


def pandascore_players(docs: DataFrame) -> DataFrame:
    """PandaScore player -> canonical player (team id from the nullable current team)."""
    d = parsed(docs, PANDASCORE_PLAYER).select("d.*")
    return d.select(F.col("id").cast("string").alias("player_id"), F.lit("pandascore").alias("source"),
                    F.col("name").alias("display_name"), F.col("current_team.id").cast("string").alias("team_id"),
                    "nationality", "match_id", "recorded_at")


def liquipedia_records(docs: DataFrame) -> DataFrame:
    """Liquipedia pages (entity, doc) -> one row per record ``r`` (text by field name), each page parsed once and each record
    held against the contract of its entity; the ones that lack a required field are left out."""
    r = parsed(docs.select("entity", "doc"), LIQUIPEDIA_RESULT).select("entity", F.explode("d.result").alias("r"))
    ok = F.lit(False)
    for entity, fields in LIQUIPEDIA_REQUIRED.items():
        present = F.col("entity") == entity
        for f in fields:
            present = present & F.col("r")[f].isNotNull()
        ok = ok | present
    return r.where(ok)


def _of(records: DataFrame, entity: str) -> DataFrame:
    return records.where(F.col("entity") == entity)


def _field(name: str) -> Column:
    return F.col("r")[name]


def liquipedia_teams(records: DataFrame) -> DataFrame:
    """Team records -> canonical teams (world ranking is never set)."""
    return _of(records, "team").select(
        _field("pagename").alias("team_id"), F.lit("liquipedia").alias("source"), _field("name").alias("name"),
        _field("region").alias("region"), F.lit(None).cast("bigint").alias("world_ranking"), _field("date").alias("ingested_at"))


def liquipedia_players(records: DataFrame, recorded_at: str) -> DataFrame:
    """Player records -> canonical players; the handle is the display name."""
    return _of(records, "player").select(
        _field("pagename").alias("player_id"), F.lit("liquipedia").alias("source"), _field("id").alias("display_name"),
        _field("teampagename").alias("team_id"), _field("nationality").alias("nationality"), F.lit(recorded_at).alias("recorded_at"))


def liquipedia_matches(records: DataFrame) -> DataFrame:
    """Match records -> canonical matches; a team or date that is absent or empty is unknown."""
    known = lambda f: F.coalesce(F.nullif(_field(f), F.lit("")), F.lit(UNKNOWN))
    return _of(records, "match").select(
        _field("match2id").alias("match_id"), F.lit("liquipedia").alias("source"), known("team1").alias("team_a_id"),
        known("team2").alias("team_b_id"), _field("winner").alias("winner_id"), known("date").alias("played_at"))


def liquipedia_placements(records: DataFrame) -> DataFrame:
    """Placement records with their tournament, if that is known; a shared place ("3-4") has its best and worst."""
    t = _of(records, "tournament").select(_field("pagename").alias("_key"), _field("name").alias("tournament_name"), _field("tier").alias("tier"),
                                          _field("startdate").try_cast("date").alias("start_date"), _field("enddate").try_cast("date").alias("end_date"),
                                          _field("prizepool").try_cast("double").alias("prize_pool"))
    place = _field("place")
    best = F.regexp_extract(place, r"^\s*(\d+)\s*(?:-\s*(\d+)\s*)?$", 1).try_cast("int")
    worst = F.regexp_extract(place, r"^\s*(\d+)\s*(?:-\s*(\d+)\s*)?$", 2).try_cast("int")
    p = _of(records, "placement").select(_field("pagename").alias("page"), _field("tournament").alias("tournament"), _field("team").alias("team"),
                                         place.alias("place"), best.alias("best_place"), F.coalesce(worst, best).alias("worst_place"))
    return p.join(t, F.col("tournament") == F.col("_key"), "left").drop("_key")
