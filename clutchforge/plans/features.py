"""Planned features: what was known of two teams before their match, and a few reports.

Nothing looks at the match itself or later ones: form counts the matches before it in time,
records and ratings those of earlier days (matches of one day don't see each other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import flag, safe_ratio
from ..operators.frames import sums_before, sums_of_last
from ..operators.ranking import cohort_ranks
from ..operators.sequence import sequence_index
from ..sources.tables import Catalog
from . import core, marts

FORM_MATCHES = 10
RATING_UNITS = 10_000     # ratings are added up as whole numbers of these
GAP_BUCKETS = 10
Z_95 = 1.96               # of the normal distribution, for 95 % bounds
BLOWN_LEAD, TRAILED_BY = 10, 3
COHORT_STATS = {"avg_adr": "adr", "avg_kd_ratio": "kd", "avg_kast": "kast", "avg_rating": "rating", "avg_kills": "kills"}


def team_matches(cat: Catalog) -> DataFrame:
    """Both teams of each match: match_sk, team_id, opponent_id, map_name, day, is_win."""
    m = core.table(cat, "fact_matches").withColumn("day", F.col("played_at").try_cast("date"))

    def side(own: str, other: str) -> Column:
        return F.struct(F.col(own).alias("team_id"), F.col(other).alias("opponent_id"),
                        flag(F.col("winner_id") == F.col(own)).cast("bigint").alias("is_win"))

    both = F.explode(F.array(side("team_a_id", "team_b_id"), side("team_b_id", "team_a_id"))).alias("s")
    return m.select("match_sk", "source", "map_name", "day", both).select("match_sk", "source", "map_name", "day", "s.*")


def rolling_form(cat: Catalog, k: int = FORM_MATCHES) -> DataFrame:
    """EXT-01: each team's win rate over its last ``k`` matches before the match."""
    rows = team_matches(cat).where(F.col("day").isNotNull() & F.col("team_id").isNotNull()).select(
        "match_sk", "team_id", "day", "is_win")
    last = sums_of_last(rows, ["team_id"], [F.col("day").asc(), F.col("match_sk").asc()], {"is_win": "wins"}, k, "matches_before")
    return last.select("match_sk", "team_id", "day", "matches_before",
                       F.round(safe_ratio("wins", "matches_before"), 4).alias("form"))


def _known(matches: DataFrame, sums: DataFrame, on: dict[str, str], prefix: str) -> DataFrame:
    """``matches`` with matches and wins of ``sums`` (per group and day) as ``<prefix>_matches`` and ``<prefix>_win_rate``."""
    right = sums.select(*[F.col(theirs).alias(f"_{theirs}") for theirs in on.values()], F.col("matches").alias("_n"), F.col("wins").alias("_w"))
    same = [matches[ours].eqNullSafe(right[f"_{theirs}"]) for ours, theirs in on.items()]
    n = F.coalesce("_n", F.lit(0).cast("bigint"))
    return matches.join(right, same, "left").select(
        *matches.columns, n.alias(f"{prefix}_matches"), F.round(safe_ratio(F.col("_w"), F.col("_n")), 4).alias(f"{prefix}_win_rate"))


def prior_records(cat: Catalog) -> DataFrame:
    """EXT-02: before each csapi match, team a's record against team b (all maps, and on the match's
    map) and both teams' records on the map."""
    rows = team_matches(cat).withColumn("one", F.lit(1).cast("bigint"))
    sums = {"one": "matches", "is_win": "wins"}
    pair = sums_before(rows, ["team_id", "opponent_id"], "day", sums)
    pair_map = sums_before(rows, ["team_id", "opponent_id", "map_name"], "day", sums)
    own_map = sums_before(rows, ["team_id", "map_name"], "day", sums)
    m = core.table(cat, "fact_matches").where(F.col("source") == "csapi").select(
        "match_sk", "team_a_id", "team_b_id", "map_name", F.col("played_at").try_cast("date").alias("day"))
    against = {"team_a_id": "team_id", "team_b_id": "opponent_id"}
    m = _known(m, pair, against | {"day": "day"}, "h2h")
    m = _known(m, pair_map, against | {"map_name": "map_name", "day": "day"}, "h2h_map")
    for side in ("team_a", "team_b"):
        m = _known(m, own_map, {f"{side}_id": "team_id", "map_name": "map_name", "day": "day"}, f"{side}_map")
    return m


def rating_differential(cat: Catalog) -> DataFrame:
    """EXT-03: the average rating of either team's players as known before each csapi match, and the difference.

    A team's state at the start of a day is a sum over its player rows of earlier days. The days it is
    asked for join the days it changes on as rows without ratings, so one pass of running sums answers them."""
    stats = core.table(cat, "fact_player_stats").where(F.col("rating").isNotNull() & F.col("team_id").isNotNull()).select(
        "team_id", F.col("recorded_at").try_cast("date").alias("day"),
        F.round(F.col("rating") * RATING_UNITS).cast("bigint").alias("units"), F.lit(1).cast("bigint").alias("rated"))
    m = core.table(cat, "fact_matches").where(F.col("source") == "csapi").select(
        "match_sk", "team_a_id", "team_b_id", F.col("played_at").try_cast("date").alias("day"))
    asked = m.select(F.explode(F.array("team_a_id", "team_b_id")).alias("team_id"), "day") \
        .select("team_id", "day", F.lit(0).cast("bigint").alias("units"), F.lit(0).cast("bigint").alias("rated"))
    known = sums_before(stats.unionByName(asked), ["team_id"], "day", {"units": "units", "rated": "rated"})
    for side in ("team_a", "team_b"):
        right = known.select(F.col("team_id").alias("_t"), F.col("day").alias("_d"), "units", "rated")
        rating = F.round(safe_ratio(F.col("units"), F.col("rated") * RATING_UNITS), 4)
        m = m.join(right, (F.col(f"{side}_id") == F.col("_t")) & (F.col("day") == F.col("_d")), "left").select(
            *m.columns, rating.alias(f"{side}_rating"))
    return m.withColumn("rating_differential", F.round(F.col("team_a_rating") - F.col("team_b_rating"), 4))


def upset_rate_by_gap(cat: Catalog, buckets: int = GAP_BUCKETS) -> DataFrame:
    """EXT-04: how often the favourite loses, by ranking gap. The gaps are cut where the matches
    fall into ``buckets`` shares of about equal size (a gap lies in one bucket whole), with 95 % bounds (Wilson)."""
    m = marts.table(cat, "mart_upset_features").where(F.col("favored_team_id").isNotNull())
    per_gap = m.groupBy(F.col("ranking_delta").alias("gap")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("winner_id") != F.col("favored_team_id")).alias("upsets"))
    placed = sequence_index(per_gap, [], [F.col("gap").asc()], out="_pos", sum_cols=("n",))
    total = F.broadcast(per_gap.agg(F.sum("n").alias("total")))
    bucket = F.floor(buckets * (F.col("running_n") - F.col("n")) / F.col("total")).cast("int")
    b = placed.crossJoin(total).groupBy(bucket.alias("bucket")).agg(
        F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"), F.sum("n").alias("matches"), F.sum("upsets").alias("upsets"))
    n, p, z = F.col("matches").cast("double"), F.col("upsets") / F.col("matches"), Z_95
    middle, width = (p + z * z / (2 * n)), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return b.select("*", F.round(p, 4).alias("upset_rate"), F.round((middle - width) / (1 + z * z / n), 4).alias("lower"),
                    F.round((middle + width) / (1 + z * z / n), 4).alias("upper"))


def pressure_rates(cat: Catalog, lead: int = BLOWN_LEAD, behind: int = TRAILED_BY) -> DataFrame:
    """EXT-05: per team, maps lost after leading by ``lead`` rounds and maps won after trailing by ``behind`` at half, each
    out of the maps where that was so."""
    s = marts.map_team_summary(cat)
    won, lost = F.col("final_own_score") > F.col("final_opp_score"), F.col("final_own_score") < F.col("final_opp_score")
    led = F.col("largest_lead") >= lead
    trailed = F.col("halftime_opp_score") - F.col("halftime_own_score") >= behind
    t = s.groupBy("team_id").agg(F.count(F.lit(1)).alias("maps"), F.count_if(led).alias("maps_led"), F.count_if(led & lost).alias("leads_blown"),
                                 F.count_if(trailed).alias("maps_trailed"), F.count_if(trailed & won).alias("comebacks"))
    return t.select("*", F.round(safe_ratio("leads_blown", "maps_led"), 4).alias("lead_blown_rate"),
                    F.round(safe_ratio("comebacks", "maps_trailed"), 4).alias("comeback_rate"))


def better_cohort_percentiles(cat: Catalog) -> DataFrame:
    """EXT-06: where each player's averages stand among the players of the next better tier."""
    board = marts.player_board(cat)
    better = F.when(F.col("tier") > 1, F.col("tier") - 1)
    ranked = cohort_ranks(board, F.col("tier"), better, {c: f"{s}_in_better_tier" for c, s in COHORT_STATS.items()},
                          ["player_id", "display_name", "team_id"])
    return ranked.select("player_id", "display_name", "team_id", "tier", *[F.round(f"{s}_in_better_tier", 6).alias(f"{s}_in_better_tier")
                                                                           for s in COHORT_STATS.values()])
