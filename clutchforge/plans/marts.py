"""Analytic marts on top of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import UNRANKED, exact_avg, flag, safe_ratio, strict_greatest, tier
from ..operators.frames import near_latest
from ..operators.joins import broadcast_if_small, one_row
from ..operators.ranking import percent_ranks, percentiles_cont
from ..sources.tables import Catalog
from . import core, staging as stg

# Fixed values of the marts.
UPSET_MIN_DELTA = 5
MIN_RECENT_90_DAY_MAPS = 20
HIDDEN_GEM_PERCENTILE = 0.85
HIDDEN_GEM_MIN_STATS = 3
LEAD_THRESHOLD = 5
CLOSE_MAP_MARGIN = 2
HALFTIME_ROUND = 12
SAMPLE_LIMITED_BELOW = 20
SAMPLE_STABLE_FROM = 50


# --------------------------------------------------------------------------- upset features

def mart_upset_features(cat: Catalog) -> DataFrame:
    """csapi matches with a winner, both teams' rankings, delta, favourite and upset label."""
    def build(c: Catalog) -> DataFrame:
        m = core.table(c, "fact_matches").where(F.col("winner_id").isNotNull() & (F.col("source") == "csapi"))
        teams = broadcast_if_small(core.table(c, "dim_teams").select("team_id", "team_name", "world_ranking", "region"))
        ta = teams.select(F.col("team_id").alias("_ta_id"), F.col("team_name").alias("team_a_name"),
                          F.col("world_ranking").alias("_ta_wr"), F.col("region").alias("team_a_region"))
        tb = teams.select(F.col("team_id").alias("_tb_id"), F.col("team_name").alias("team_b_name"),
                          F.col("world_ranking").alias("_tb_wr"), F.col("region").alias("team_b_region"))
        j = (m.join(ta, m["team_a_id"] == ta["_ta_id"], "left")
             .join(tb, m["team_b_id"] == tb["_tb_id"], "left"))
        ra = F.coalesce("team_a_ranking", "_ta_wr", F.lit(UNRANKED))
        rb = F.coalesce("team_b_ranking", "_tb_wr", F.lit(UNRANKED))
        e = j.select(
            "match_sk", "match_id", "source", "team_a_id", "team_b_id", "winner_id", "map_name", "played_at",
            "score_a", "score_b", "is_overtime", "team_a_name", "team_b_name",
            F.coalesce("team_a_ranking", "_ta_wr").alias("team_a_ranking"),
            F.coalesce("team_b_ranking", "_tb_wr").alias("team_b_ranking"),
            "team_a_region", "team_b_region",
            F.abs(ra - rb).alias("ranking_delta"),
            F.when(ra < rb, F.col("team_a_id")).when(rb < ra, F.col("team_b_id")).alias("favored_team_id"),
            (F.coalesce("score_a", F.lit(0)) - F.coalesce("score_b", F.lit(0))).alias("score_diff"),
            (F.coalesce("score_a", F.lit(0)) + F.coalesce("score_b", F.lit(0))).alias("total_rounds"),
        )
        upset = (F.col("favored_team_id").isNotNull() & (F.col("winner_id") != F.col("favored_team_id"))
                 & (F.col("ranking_delta") > UPSET_MIN_DELTA))
        return e.select("*", flag(upset).alias("is_upset"),
                        flag(F.col("team_a_region") != F.col("team_b_region")).alias("is_cross_region"))
    return cat.memo("mart_upset_features", build)


# --------------------------------------------------------------------------- team results

def team_match_rows(cat: Catalog) -> DataFrame:
    """Each match twice, once per team, from one scan (explode of two structs)."""
    m = core.table(cat, "fact_matches")
    w = F.col("winner_id")

    def side(team: str) -> Column:
        t = F.col(team)
        return F.struct(t.alias("team_id"), F.col("played_at").alias("played_at"),
                        flag(w == t).alias("is_win"),
                        flag(w.isNotNull() & (w != t)).alias("is_loss"),
                        flag(w.isNull()).alias("is_draw"))

    return m.select(F.explode(F.array(side("team_a_id"), side("team_b_id"))).alias("r")).select("r.*")


def mart_team_performance(cat: Catalog) -> DataFrame:
    tm = team_match_rows(cat)
    agg = tm.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.sum("is_win").cast("bigint").alias("wins"),
        F.sum("is_loss").cast("bigint").alias("losses"),
        F.sum("is_draw").cast("bigint").alias("draws"),
    )
    agg = agg.withColumn("win_rate", F.round(safe_ratio("wins", "total_matches"), 4))
    teams = broadcast_if_small(core.table(cat, "dim_teams").select("team_id", "team_name", "region", "world_ranking"))
    return (agg.join(teams, "team_id", "left")
            .select("team_id", "team_name", "region", "world_ranking", "total_matches", "wins", "losses",
                    "draws", "win_rate"))


def mart_head2head(cat: Catalog) -> DataFrame:
    m = core.table(cat, "fact_matches")
    a, b = F.col("team_a_id"), F.col("team_b_id")
    p = m.select(F.when(a < b, a).otherwise(b).alias("team_1_id"),
                 F.when(a < b, b).otherwise(a).alias("team_2_id"), "winner_id", "played_at")
    w = F.col("winner_id")
    return p.groupBy("team_1_id", "team_2_id").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.sum(flag(w == F.col("team_1_id"))).cast("bigint").alias("team_1_wins"),
        F.sum(flag(w == F.col("team_2_id"))).cast("bigint").alias("team_2_wins"),
        F.sum(flag(w.isNull())).cast("bigint").alias("draws"),
        F.min("played_at").alias("first_match"),
        F.max("played_at").alias("last_match"),
    )


def mart_map_meta(cat: Catalog) -> DataFrame:
    m = core.table(cat, "fact_matches").where(F.col("map_name").isNotNull())
    total = one_row(m.agg(F.count(F.lit(1)).alias("total")))
    w = F.col("winner_id")
    decided = F.count(F.when(w.isNotNull(), F.lit(1)))
    agg = m.crossJoin(total).groupBy("map_name", "total").agg(
        F.count(F.lit(1)).alias("times_played"),
        F.sum(flag(w == F.col("team_a_id"))).alias("_a_wins"),
        F.sum(flag(w == F.col("team_b_id"))).alias("_b_wins"),
        decided.alias("_decided"),
        F.avg(F.coalesce("score_a", F.lit(0)) + F.coalesce("score_b", F.lit(0))).alias("_avg_rounds"),
    )
    return agg.select(
        "map_name", "times_played",
        F.round(safe_ratio("times_played", "total"), 4).alias("pick_rate"),
        F.round(safe_ratio("_a_wins", "_decided"), 4).alias("team_a_win_rate"),
        F.round(safe_ratio("_b_wins", "_decided"), 4).alias("team_b_win_rate"),
        F.round("_avg_rounds", 1).alias("avg_total_rounds"),
    )


# --------------------------------------------------------------------------- players

def _player_team(cat: Catalog) -> DataFrame:
    """Player stat rows with the team taken from the player's latest record."""
    s = core.table(cat, "fact_player_stats")
    cp = core.table(cat, "dim_players").select("player_id", F.col("team_id").alias("_current_team_id"))
    j = s.join(cp, "player_id", "left")
    return j.withColumn("_team_key", F.coalesce("_current_team_id", "team_id"))


def player_board(cat: Catalog) -> DataFrame:
    """Averages of each player under the current team, with the team's tier; stored, as ranks read it several times."""
    return cat.raw("player_board", _player_board)


def _player_board(cat: Catalog) -> DataFrame:
    j = _player_team(cat)
    agg = j.groupBy("player_id", "display_name", F.col("_team_key").alias("team_id")).agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.round(exact_avg("adr"), 2).alias("avg_adr"),
        F.round(exact_avg("kd_ratio"), 3).alias("avg_kd_ratio"),
        F.round(exact_avg("kast"), 2).alias("avg_kast"),
        F.round(exact_avg("rating"), 3).alias("avg_rating"),
        F.round(exact_avg("kills"), 1).alias("avg_kills"),
        F.round(exact_avg("deaths"), 1).alias("avg_deaths"),
        F.max("elo").alias("peak_elo"),
    )
    teams = broadcast_if_small(core.table(cat, "dim_teams").select("team_id", "world_ranking"))
    return agg.join(teams, "team_id", "left").withColumn("tier", tier("world_ranking"))


def mart_player_leaderboard(cat: Catalog) -> DataFrame:
    t = percent_ranks(player_board(cat), ["tier"], {"avg_adr": "adr_pct_rank", "avg_kd_ratio": "kd_pct_rank",
                                    "avg_kast": "kast_pct_rank", "avg_rating": "rating_pct_rank",
                                    "avg_kills": "kills_pct_rank"},
                      key_cols=["player_id", "display_name", "team_id"])
    return t.select("player_id", "display_name", "team_id", "matches_played", "avg_adr", "avg_kd_ratio",
                    "avg_kast", "avg_rating", "avg_kills", "avg_deaths", "peak_elo", "world_ranking", "tier",
                    "adr_pct_rank", "kd_pct_rank", "kast_pct_rank", "rating_pct_rank", "kills_pct_rank")


def player_match_stats(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        j = _player_team(c)
        teams = broadcast_if_small(core.table(c, "dim_teams").select(
            F.col("team_id").alias("_t_id"), "team_name", F.col("region").alias("team_region"), "world_ranking"))
        j = j.join(teams, j["_team_key"] == teams["_t_id"], "left")
        return j.select("player_id", "display_name", F.col("_team_key").alias("team_id"), "team_name",
                        "team_region", F.col("recorded_at").try_cast("date").alias("recorded_at"),
                        "adr", "kd_ratio", "kast", "rating", "kills",
                        tier("world_ranking").alias("player_tier"), "world_ranking")
    return cat.memo("player_match_stats", build)


def hidden_gem_player_agg(cat: Catalog) -> DataFrame:
    """Averages of each player and team; stored, as thresholds and scores read it."""
    return cat.raw("hidden_gem_players", _hidden_gem_player_agg)


def _hidden_gem_player_agg(cat: Catalog) -> DataFrame:
    pms = player_match_stats(cat)
    return pms.groupBy("player_id", "display_name", "team_id", "team_name", "team_region", "world_ranking",
                       "player_tier").agg(
        F.count(F.lit(1)).alias("matches_played"),
        exact_avg("adr").alias("avg_adr"), exact_avg("kd_ratio").alias("avg_kd_ratio"),
        exact_avg("kast").alias("avg_kast"), exact_avg("rating").alias("avg_rating"),
        exact_avg("kills").alias("avg_kills"), F.max("recorded_at").alias("latest_recorded_at"))


GEM_STATS = [("avg_adr", "adr_threshold"), ("avg_kd_ratio", "kd_threshold"),
             ("avg_kast", "kast_threshold"), ("avg_rating", "rating_threshold")]


def tier_thresholds(cat: Catalog, worst: int | None = None) -> DataFrame:
    """85th percentile (exact, interpolated) of four averages per tier (up to tier ``worst``)."""
    pa = hidden_gem_player_agg(cat)
    if worst is not None:
        pa = pa.where(F.col("player_tier") <= worst)
    return percentiles_cont(pa, ["player_tier"], dict(GEM_STATS), HIDDEN_GEM_PERCENTILE,
                            key_cols=["player_id", "display_name", "team_id", "team_name", "team_region"])


TREND_STATS = ("adr", "kd_ratio", "kast", "rating")


def player_trends(cat: Catalog) -> DataFrame:
    """Recent (anchor - 89 days .. anchor) and previous (anchor - 179 .. anchor - 90)
    averages per player; the anchor is the player's latest date. The anchors come first, from ids and dates alone, so
    that only the rows inside the windows are summed (combined map-side). Rows that can't be in a window, as a later one of
    the player lies beside them, are left out before rows and anchors are shuffled together. Nothing of a team is read,
    so the rows are the fact's. A player without dates keeps a row."""
    stats = core.table(cat, "fact_player_stats").select("player_id", F.col("recorded_at").try_cast("date").alias("recorded_at"), *TREND_STATS)
    anchors = stats.groupBy(F.col("player_id").alias("_p")).agg(F.max("recorded_at").alias("_anchor"))
    exact = {s: F.col(s).cast("decimal(28,10)") for s in TREND_STATS}
    d, a = F.col("recorded_at"), F.col("_anchor")
    recent = d >= F.date_sub(a, 89)
    prev = (d < F.date_sub(a, 89)) & (d >= F.date_sub(a, 179))
    spans = (("recent", recent), ("previous", prev))
    aggs = [F.count_if(span).alias(f"{name}_90_day_maps_played") for name, span in spans]
    for name, span in spans:
        for s in TREND_STATS:
            total, count = F.sum(F.when(span, exact[s])), F.count(F.when(span, exact[s]))
            aggs.append(F.try_divide(total, F.nullif(count, F.lit(0))).cast("double").alias(f"{name}_90_day_{s}"))
    rows = near_latest(stats, "player_id", "recorded_at", 179)
    dated = rows.join(anchors, rows["player_id"] == anchors["_p"]).where(a.isNull() | (d >= F.date_sub(a, 179)))
    return dated.groupBy("player_id").agg(*aggs)


def _gap(window_avg: str, threshold: str) -> Column:
    return F.when(F.col(window_avg).isNotNull() & F.nullif(F.col(threshold), F.lit(0.0)).isNotNull(),
                  F.col(window_avg) / F.col(threshold) - 1)


def _mean_of_available(cols: list[str]) -> Column:
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((flag(F.col(c).isNotNull()) for c in cols), F.lit(0))
    return F.try_divide(total, F.nullif(n, F.lit(0)).cast("double"))


def hidden_gems_scored(cat: Catalog) -> DataFrame:
    pa = hidden_gem_player_agg(cat).where(F.col("player_tier") > 1)
    th = tier_thresholds(cat, worst=3)  # the tier above tier 4 is tier 3
    th = F.broadcast(th.withColumn("_join_tier", F.col("player_tier") + 1).drop("player_tier"))  # <= 4 rows
    tr = player_trends(cat)
    j = pa.join(th, pa["player_tier"] == th["_join_tier"], "left").drop("_join_tier").join(tr, "player_id", "left")
    clears = [flag(F.col(s) >= F.col(t)) for s, t in GEM_STATS]
    j = j.select("*",
                 sum(clears[1:], clears[0]).alias("stats_above_tier_threshold"),
                 F.round(sum((c * 25 for c in clears[1:]), clears[0] * 25)
                         + F.least(F.col("matches_played"), F.lit(50)) / 10.0, 2).alias("prospect_score"),
                 F.lit(MIN_RECENT_90_DAY_MAPS).alias("minimum_recent_90_day_maps"))
    gaps = {}
    for win in ["recent", "previous"]:
        for s, t in [("adr", "adr_threshold"), ("kd_ratio", "kd_threshold"), ("kast", "kast_threshold"),
                     ("rating", "rating_threshold")]:
            short = "kd" if s == "kd_ratio" else s
            gaps[f"{win}_{short}_gap"] = _gap(f"{win}_90_day_{s}", t)
    j = j.select("*", *[v.alias(k) for k, v in gaps.items()])
    j = j.select("*",
                 _mean_of_available([k for k in gaps if k.startswith("recent")]).alias("recent_90_day_gap_to_tier_above"),
                 _mean_of_available([k for k in gaps if k.startswith("previous")]).alias("previous_90_day_gap_to_tier_above"))
    return j


def mart_hidden_gems(cat: Catalog) -> DataFrame:
    s = hidden_gems_scored(cat).where(F.col("stats_above_tier_threshold") >= HIDDEN_GEM_MIN_STATS)
    rg, pg = F.col("recent_90_day_gap_to_tier_above"), F.col("previous_90_day_gap_to_tier_above")
    trend = (F.when(pg.isNull() | rg.isNull(), F.lit("insufficient_history"))
             .when(rg > pg, F.lit("gap_growing"))
             .when(rg < pg, F.lit("gap_shrinking"))
             .otherwise(F.lit("gap_flat")))
    r = F.round
    return s.select(
        "player_id", "display_name", "team_id", "team_name", "team_region", "world_ranking", "player_tier",
        (F.col("player_tier") - 1).alias("comparison_tier"), "matches_played",
        r("avg_adr", 2).alias("avg_adr"), r("avg_kd_ratio", 3).alias("avg_kd_ratio"),
        r("avg_kast", 2).alias("avg_kast"), r("avg_rating", 3).alias("avg_rating"),
        r("avg_kills", 1).alias("avg_kills"),
        r("adr_threshold", 2).alias("tier_above_adr_threshold"),
        r("kd_threshold", 3).alias("tier_above_kd_threshold"),
        r("kast_threshold", 2).alias("tier_above_kast_threshold"),
        r("rating_threshold", 3).alias("tier_above_rating_threshold"),
        "stats_above_tier_threshold", "prospect_score", "recent_90_day_maps_played",
        "previous_90_day_maps_played", "minimum_recent_90_day_maps",
        (F.col("recent_90_day_maps_played") >= F.col("minimum_recent_90_day_maps")).alias("meets_recent_sample_size"),
        r("recent_90_day_adr", 2).alias("recent_90_day_adr"),
        r("recent_90_day_kd_ratio", 3).alias("recent_90_day_kd_ratio"),
        r("recent_90_day_kast", 2).alias("recent_90_day_kast"),
        r("recent_90_day_rating", 3).alias("recent_90_day_rating"),
        r("previous_90_day_adr", 2).alias("previous_90_day_adr"),
        r("previous_90_day_kd_ratio", 3).alias("previous_90_day_kd_ratio"),
        r("previous_90_day_kast", 2).alias("previous_90_day_kast"),
        r("previous_90_day_rating", 3).alias("previous_90_day_rating"),
        r(rg, 4).alias("recent_90_day_gap_to_tier_above"),
        r(pg, 4).alias("previous_90_day_gap_to_tier_above"),
        r(rg - pg, 4).alias("gap_delta_to_tier_above"),
        trend.alias("trend_direction"),
        F.lit(True).alias("is_hidden_gem"),
    )


# --------------------------------------------------------------------------- pressure profile

def mirrored_team_rounds(cat: Catalog) -> DataFrame:
    """Each round twice, from each team's side, with scores before and after."""
    r = stg.stg_hltv_round_history(cat)

    def side(team, opp, own_after, opp_after) -> Column:
        return F.struct(F.col(team).alias("team_id"), F.col(team.replace("_id", "_name")).alias("team_name"),
                        F.col(opp).alias("opponent_id"), F.col(opp.replace("_id", "_name")).alias("opponent_name"),
                        F.col(own_after).alias("own_score_after"), F.col(opp_after).alias("opp_score_after"))

    m = r.select("map_stats_id", "match_id", "map_name", "played_at", "round_number", "winner_team_id",
                 "is_overtime",
                 F.explode(F.array(side("team1_id", "team2_id", "score_team1_after", "score_team2_after"),
                                   side("team2_id", "team1_id", "score_team2_after", "score_team1_after")))
                 .alias("s")).select("*", "s.*").drop("s")
    won = flag(F.col("winner_team_id") == F.col("team_id"))
    lost = flag(F.col("winner_team_id") != F.col("team_id"))
    return m.select("*", won.alias("won_round"),
                    (F.col("own_score_after") - won).alias("own_score_before"),
                    (F.col("opp_score_after") - lost).alias("opp_score_before"))


def map_team_summary(cat: Catalog) -> DataFrame:
    """One row per (map, team). Final scores and map length are maxima over the
    map; inside a (map, team) group every row carries that team's side, so
    the group maxima equal the map-wide window maxima of the model and no
    separate window pass is needed. ``any_value`` is made deterministic with max."""
    t = mirrored_team_rounds(cat)
    lead = strict_greatest(F.col("own_score_before") - F.col("opp_score_before"),
                           F.col("own_score_after") - F.col("opp_score_after"))
    half = F.col("round_number") == HALFTIME_ROUND
    return t.groupBy("map_stats_id", "team_id").agg(
        F.max("match_id").alias("match_id"), F.max("map_name").alias("map_name"),
        F.max("played_at").alias("played_at"), F.max("team_name").alias("team_name"),
        F.max("opponent_id").alias("opponent_id"), F.max("opponent_name").alias("opponent_name"),
        F.max("own_score_after").alias("final_own_score"),
        F.max("opp_score_after").alias("final_opp_score"),
        F.max("round_number").alias("total_rounds"),
        F.max(flag(F.col("is_overtime"))).alias("is_overtime_map"),
        F.max(lead).alias("largest_lead"),
        F.max(F.when(half, F.col("own_score_after"))).alias("halftime_own_score"),
        F.max(F.when(half, F.col("opp_score_after"))).alias("halftime_opp_score"),
    )


def map_team_flags(cat: Catalog) -> DataFrame:
    s = map_team_summary(cat)
    own, opp = F.col("final_own_score"), F.col("final_opp_score")
    ho, hp = F.col("halftime_own_score"), F.col("halftime_opp_score")
    return s.select(
        "*",
        flag(own > opp).alias("won_map"),
        flag(own < opp).alias("lost_map"),
        flag(F.abs(own - opp) <= CLOSE_MAP_MARGIN).alias("is_close_map"),
        flag(F.col("largest_lead") >= LEAD_THRESHOLD).alias("had_5plus_lead"),
        flag((F.col("largest_lead") >= LEAD_THRESHOLD) & (own < opp)).alias("lead_blown_5plus"),
        flag(ho > hp).alias("had_halftime_lead"),
        flag((ho > hp) & (own < opp)).alias("halftime_lead_lost"),
        flag((ho < hp) & (own > opp)).alias("halftime_comeback_win"),
    )


def team_pressure(cat: Catalog) -> DataFrame:
    f = map_team_flags(cat)
    ot_win = flag((F.col("is_overtime_map") == 1) & (F.col("won_map") == 1))
    ot_loss = flag((F.col("is_overtime_map") == 1) & (F.col("lost_map") == 1))
    close_win = flag((F.col("is_close_map") == 1) & (F.col("won_map") == 1))
    a = f.groupBy("team_id").agg(
        F.max("team_name").alias("team_name"),
        F.count(F.lit(1)).alias("total_maps"),
        F.sum("total_rounds").cast("bigint").alias("rounds_analyzed"),
        F.sum("won_map").cast("bigint").alias("wins"),
        F.sum("lost_map").cast("bigint").alias("losses"),
        F.max("largest_lead").alias("largest_lead"),
        F.sum("had_5plus_lead").cast("bigint").alias("maps_with_5plus_lead"),
        F.sum("lead_blown_5plus").cast("bigint").alias("leads_blown"),
        F.sum("halftime_lead_lost").cast("bigint").alias("halftime_leads_lost"),
        F.sum("halftime_comeback_win").cast("bigint").alias("halftime_comeback_wins"),
        F.sum("is_overtime_map").cast("bigint").alias("ot_matches"),
        F.sum(ot_win).cast("bigint").alias("ot_wins"),
        F.sum(ot_loss).cast("bigint").alias("ot_losses"),
        F.sum("is_close_map").cast("bigint").alias("close_maps"),
        F.sum(close_win).cast("bigint").alias("close_map_wins"),
    )
    return a.select(
        "*",
        F.round(safe_ratio("leads_blown", "maps_with_5plus_lead"), 4).alias("lead_blown_rate"),
        F.round(safe_ratio("halftime_comeback_wins", "wins"), 4).alias("comeback_rate"),
        F.round(safe_ratio("ot_wins", "ot_matches"), 4).alias("ot_win_rate"),
        F.round(safe_ratio("close_map_wins", "close_maps"), 4).alias("close_map_win_rate"),
    )


def league_averages(team_agg: DataFrame) -> DataFrame:
    s = team_agg.agg(
        F.sum("leads_blown").alias("a"), F.sum("maps_with_5plus_lead").alias("b"),
        F.sum("halftime_comeback_wins").alias("c"), F.sum("wins").alias("d"),
        F.sum("ot_wins").alias("e"), F.sum("ot_matches").alias("f"),
        F.sum("close_map_wins").alias("g"), F.sum("close_maps").alias("h"))
    return s.select(
        F.round(safe_ratio("a", "b"), 4).alias("league_lead_blown_rate"),
        F.round(safe_ratio("c", "d"), 4).alias("league_halftime_comeback_rate"),
        F.round(safe_ratio("e", "f"), 4).alias("league_ot_win_rate"),
        F.round(safe_ratio("g", "h"), 4).alias("league_close_map_win_rate"))


def mart_choke_profile(cat: Catalog) -> DataFrame:
    ta = team_pressure(cat)
    la = one_row(league_averages(ta))
    teams = broadcast_if_small(core.table(cat, "dim_teams").select(
        F.col("team_id").alias("_t_id"), F.col("team_name").alias("_t_name"), "world_ranking"))
    j = ta.crossJoin(la).join(teams, ta["team_id"] == teams["_t_id"], "left")
    c = F.col
    return j.select(
        "team_id", F.coalesce("_t_name", "team_name").alias("team_name"), "world_ranking",
        "total_maps", c("total_maps").alias("maps_analyzed"), c("total_maps").alias("total_scored_matches"),
        "rounds_analyzed", "wins", "losses", "largest_lead", "maps_with_5plus_lead", "leads_blown",
        "lead_blown_rate", F.coalesce("lead_blown_rate", F.lit(0.0)).alias("lead_blown_rate_display"),
        (c("lead_blown_rate") - c("league_lead_blown_rate")).alias("lead_blown_rate_delta"),
        "halftime_leads_lost", c("halftime_comeback_wins").alias("comebacks"), "comeback_rate",
        c("comeback_rate").alias("halftime_comeback_rate"),
        F.coalesce("comeback_rate", F.lit(0.0)).alias("halftime_comeback_rate_display"),
        (c("comeback_rate") - c("league_halftime_comeback_rate")).alias("halftime_comeback_rate_delta"),
        F.lit("round_history_exact").alias("comeback_metric_type"),
        F.lit(True).alias("halftime_data_available"),
        "ot_matches", c("ot_matches").alias("overtime_maps_analyzed"), "ot_wins", "ot_losses", "ot_win_rate",
        F.coalesce("ot_win_rate", F.lit(0.0)).alias("ot_win_rate_display"),
        (c("ot_win_rate") - c("league_ot_win_rate")).alias("ot_win_rate_delta"),
        "close_maps", c("close_maps").alias("close_maps_analyzed"), "close_map_wins", "close_map_win_rate",
        F.coalesce("close_map_win_rate", F.lit(0.0)).alias("close_map_win_rate_display"),
        (c("close_map_win_rate") - c("league_close_map_win_rate")).alias("close_map_win_rate_delta"),
        F.lit(SAMPLE_STABLE_FROM).alias("minimum_stable_maps"),
        F.when(c("total_maps") < SAMPLE_LIMITED_BELOW, F.lit("limited"))
        .when(c("total_maps") < SAMPLE_STABLE_FROM, F.lit("directional"))
        .otherwise(F.lit("stable")).alias("sample_quality"),
        (c("total_maps") < SAMPLE_LIMITED_BELOW).alias("sample_size_warning"),
        F.lit("hltv_unofficial").alias("metric_source"),
        F.lit(True).alias("round_history_available"),
        F.lit(False).alias("clutch_data_available"),
        F.lit(False).alias("bracket_data_available"),
        F.lit(None).cast("double").alias("elimination_win_pct"),
        F.lit(None).cast("double").alias("winners_bracket_win_pct"),
    )


# ----------------------------------------------------------------------------- materialised marts
MART_TABLES = {f.__name__: f for f in (mart_upset_features, mart_team_performance, mart_head2head, mart_map_meta,
                                       mart_player_leaderboard, mart_hidden_gems, mart_choke_profile)}


def table(cat: Catalog, name: str) -> DataFrame:
    """A mart as its readers get it: built once per input and code version and stored as Parquet,
    like the core tables. The registered ``mart_*`` queries run the builders themselves."""
    return cat.raw(name, MART_TABLES[name])
