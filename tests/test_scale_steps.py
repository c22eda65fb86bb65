"""Steps of the star schema that must not sort, move or write more than they need."""

import datetime as dt
import re

from pyspark.sql import functions as F

from clutchforge.operators import normalize
from clutchforge.operators.dedupe import desc_nulls_last, keep_first, keep_first_laid_out
from clutchforge.operators.frames import near_latest
from clutchforge.plans import core, marts
from clutchforge.plans import staging as stg
from clutchforge.session import FIRST_PARTITIONS, TASK_LIMITS, configure, shuffle_tasks, size_shuffles
from clutchforge.sources import payloads, standins
from clutchforge.sources.tables import Catalog

from .conftest import SF_SMALL


def test_keep_first_moves_a_row_once(spark):
    df = spark.createDataFrame([("a", "1", 2.0), ("a", "1", 3.0), ("b", None, None)], "k string, d string, v double")
    got = keep_first(df, ["k"], desc_nulls_last(F.col("d")))
    assert sorted(got.collect(), key=str) == sorted([("a", "1", 3.0), ("b", None, None)], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and got.columns == ["k", "d", "v"]


def test_raw_layer_is_written_without_a_sort(spark):
    assert int(configure(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 4


def test_limits_of_a_task(spark):
    before = {k: spark.conf.get(k) for k in TASK_LIMITS}
    try:
        for k in TASK_LIMITS:
            spark.conf.set(k, "1g")
        configure(spark)
        assert {k: spark.conf.get(k) for k in TASK_LIMITS} == {k: str(v) for k, v in TASK_LIMITS.items()}
        for k in TASK_LIMITS:
            spark.conf.set(k, "1m")
        configure(spark)
        assert {spark.conf.get(k) for k in TASK_LIMITS} == {"1m"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffles_grow_with_the_input(spark):
    try:
        size_shuffles(spark, 6_000_000_000)
        assert shuffle_tasks(spark) == 1431
        size_shuffles(spark, 1000)
        assert shuffle_tasks(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(FIRST_PARTITIONS)


def test_player_tables_share_one_dedupe(spark):
    cat = Catalog(configure(spark), SF_SMALL)
    fact = core.table(cat, "fact_player_stats")
    assert all("core_int_players" in f for f in fact.inputFiles())
    moved = core.dim_players(cat)._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"ReadSchema: struct<([^>]*)>", moved) or re.search(r"FileScan parquet \[([^\]]*)\]", moved)
    assert "adr" not in scan.group(1) and "kills" not in scan.group(1)


def test_trend_windows_against_brute_force(spark):
    cat = Catalog(configure(spark), SF_SMALL)
    day = lambda s: dt.date.fromisoformat(s)
    rows = [("p", day("2026-05-01"), 10.0), ("p", day("2026-02-01"), 20.0), ("p", day("2026-01-31"), 40.0), ("p", day("2025-11-03"), 80.0),
            ("p", day("2025-11-02"), 160.0), ("p", None, 1.0), ("q", None, 5.0)]
    stats = spark.createDataFrame(rows, "player_id string, recorded_at date, adr double").select(
        "*", *[F.lit(None).cast("double").alias(c) for c in ("kd_ratio", "kast", "rating")])
    cat._memo["player_match_stats"] = cat._memo["fact_player_stats"] = stats
    trends = marts.player_trends(cat)
    assert "Window" not in trends._jdf.queryExecution().executedPlan().toString()  # no pass over sums of all days
    got = {r["player_id"]: r for r in trends.collect()}
    p, q = got["p"], got["q"]
    assert (p["recent_90_day_maps_played"], p["previous_90_day_maps_played"]) == (2, 2)
    assert (p["recent_90_day_adr"], p["previous_90_day_adr"], p["recent_90_day_kast"]) == (15.0, 60.0, None)
    assert (q["recent_90_day_maps_played"], q["previous_90_day_maps_played"], q["recent_90_day_adr"]) == (0, 0, None)


def _exchanges(df):
    return re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_stored_players_are_moved_once(spark):
    cat = Catalog(configure(spark), SF_SMALL)
    laid = keep_first_laid_out(stg.players_unioned_raw(cat), stg.player_grain(), stg.first_provider(), 7)
    assert _exchanges(laid) == ["rangepartitioning"]  # its aggregate runs inside the ranges
    plain = stg.int_players_unioned(cat)
    assert laid.count() == plain.count() and laid.exceptAll(plain).count() == 0


def test_rows_of_a_hot_key_are_collapsed_before_they_move(spark):
    rows = [("hot", None, float(i % 50)) for i in range(300)] + [(f"k{i % 40}", f"m{i % 3}" if i % 5 else None, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    keys, order = ["k", F.coalesce("m", F.lit("none"))], desc_nulls_last(F.col("v"))
    want = sorted(keep_first(df, keys, order).collect(), key=str)
    assert sorted(keep_first_laid_out(df, keys, order, 4).collect(), key=str) == want
    split = keep_first_laid_out(df, keys, order, 4, most_rows=250)
    assert sorted(_exchanges(split)) == ["hashpartitioning", "rangepartitioning", "rangepartitioning"]
    assert sorted(split.collect(), key=str) == want


def test_line_pairs_move_a_line_once(spark):
    pairs = standins.lineitem_pairs(Catalog(configure(spark), SF_SMALL))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan  # the winner's fields are in what it is chosen by


def test_averages_of_players_are_made_once(spark):
    cat = Catalog(configure(spark), SF_SMALL)
    assert all("player_board" in f for f in marts.player_board(cat).inputFiles())
    assert all("hidden_gem_players" in f for f in marts.hidden_gem_player_agg(cat).inputFiles())


def _read_columns(df):
    """The columns of each file scan of a plan."""
    return [set(re.findall(r"(\w+)#", cols)) for cols in re.findall(r"FileScan parquet \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())]


def test_line_pairs_move_what_a_match_is_made_of(spark):
    (read,) = _read_columns(standins.lineitem_pairs(Catalog(configure(spark), SF_SMALL)))
    assert read == {"l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"}


def test_line_pairs_of_repeated_lines(spark):
    day = lambda d: dt.datetime(1995, 1, d)
    rows = [(1, 1, 7, 3, 9.0, 5.0, day(1)), (1, 1, 8, 2, 1.0, 4.0, day(2)), (1, 1, 8, 2, 2.0, 3.0, day(2)), (1, 2, 5, 6, 4.0, 1.0, None),
            (1, 2, 5, 6, 4.0, 2.0, None), (2, 1, 1, 1, 1.0, 1.0, day(1)), (3, 1, 1, 4, 1.0, 1.0, day(1)), (3, 2, 1, 4, 1.0, 1.0, day(1))]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                                        "l_extendedprice double, l_shipdate timestamp")
    cat = Catalog(configure(spark), SF_SMALL)
    cat.table = lambda name: lines
    got = standins.lineitem_pairs(cat).select("l_orderkey", "a.l_partkey", "a.l_suppkey", "a.l_quantity", "b.l_suppkey", "b.l_quantity").collect()
    assert [tuple(r) for r in got] == [(1, 8, 2, 2.0, 6, 4.0)]  # no pair without a second line or within one team


def test_rows_near_the_latest_day(spark):
    day = lambda n: dt.date(2026, 1, 1) + dt.timedelta(n)
    rows = [("p", day(200), 1), ("p", day(21), 2), ("p", day(20), 3), ("p", None, 4), ("q", None, 5), ("q", None, 6), (None, day(0), 7), ("r", day(0), 8)]
    df = spark.createDataFrame(rows, "k string, d date, n int")
    assert sorted(r["n"] for r in near_latest(df.coalesce(1), "k", "d", 179).collect()) == [1, 2, 5, 6, 7, 8]
    parted = near_latest(df.repartition(8, "n"), "k", "d", 179)  # rows apart: nothing may be missing
    assert {1, 2, 5, 6, 7, 8} <= {r["n"] for r in parted.collect()} and parted.schema == df.schema


def test_trends_leave_old_rows_out_before_the_shuffle(spark):
    trends = marts.player_trends(Catalog(configure(spark), SF_SMALL))
    plan = trends._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("MapInArrow")  # the tree is printed from the result down
    assert all("team_id" not in read and "display_name" not in read for read in _read_columns(trends))


def test_cached_documents_gather_a_row_once(spark):
    cat = Catalog(configure(spark), SF_SMALL)
    stat = lambda match, player, team, kills: (str(player), "csapi", f"n{player}", team, kills, 5.0, 70.0, 0.5, 1.1, str(match))
    rows = [stat(2, 1, "4", 7.0), stat(2, 2, "-1", 8.0), stat(2, 3, None, 9.0), stat(2, 1, "4", 7.0), stat(3, 26, "5", None)]
    cat._memo["raw:raw_players"] = spark.createDataFrame(
        rows, "player_id string, source string, display_name string, team_id string, kills double, deaths double, adr double, kast double, "
              "rating double, match_id string").select("*", *[F.lit(None).cast("string").alias(c) for c in (
                  "team_name", "nationality", "kd_ratio", "swing", "matches_played", "elo", "recorded_at")])
    docs = payloads.cached_match_docs(cat)
    assert len(re.findall(r"(?<!partial_)collect_list\(", re.search(r"Aggregate\(keys=[^\n]*", docs._jdf.queryExecution().executedPlan().toString()).group(0))) == 1
    got = normalize.side_players(docs).select("match_id", "map_stats_id", "team", "side", "player_id", "kills").collect()
    want = [("2", f"2{m}", team, side, player, kills) for m in (1, 2) for team, player, k in (("team1", "1", 7), ("team1", "1", 7), ("team2", "2", 8))
            for side, kills in (("combined", k), ("t", k // 2), ("ct", k - k // 2))]
    want += [("3", "31", "team2", side, "26", kills) for side, kills in (("combined", None), ("ct", None))]
    assert sorted(map(tuple, got), key=str) == sorted([(*w[:5], None if w[5] is None else float(w[5])) for w in want], key=str)
