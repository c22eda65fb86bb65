"""Raw match-domain tables derived from the driver's TPC-H-like tables.

The jobs in ``plans`` read raw tables with the contracts of ``schemas``. In
tests, bench and the correctness check those raw tables are derived here from
the driver tables (rules in FIXTURES.md section C). Everything is a lazy
DataFrame over the whole input, so the work grows with the data.

Derivation rules use key arithmetic (``key % n``) only to give the stand-ins
the variety the jobs must handle (unranked teams, ambiguous names, several
providers); every supplier, part, line item and event has its rows. A match needs two
lines of an order with different suppliers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import iso_date_text, normalize_team_name
from ..operators.sequence import sequence_index
from .tables import Catalog

# Fixed values of the stand-ins.
RANKING_DATES = ("2026-04-06", "2026-05-04")
PROFILE_DATE = "1994-12-31"
ORDER_STATUS_SOURCE = {"O": "csapi", "F": "faceit", "P": "pandascore"}
RETURNFLAG_SOURCE = {"R": "faceit", "A": "pandascore", "N": "csapi"}
ROUND_LOADED_AT = "2026-05-04T00:00:00"


def team_name_of(team_id) -> F.Column:
    """Supplier-style display name for a numeric team id given as text."""
    return F.concat(F.lit("Supplier#"), F.lpad(team_id, 9, "0"))


def _case(colname: str, mapping: dict[str, str]) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(colname) == k, F.lit(v)) if out is None else out.when(F.col(colname) == k, F.lit(v))
    return out


# --------------------------------------------------------------------------- teams

def supplier_geo(cat: Catalog) -> DataFrame:
    """Suppliers with their region name. nation (25 rows) and region (5 rows)
    have a fixed size in this schema, so broadcasting them is bounded."""
    def build(c: Catalog) -> DataFrame:
        nation = c.table("nation").select("n_nationkey", "n_regionkey")
        region = c.table("region").select("r_regionkey", "r_name")
        geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
        sup = c.table("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
        return (sup.join(geo, sup.s_nationkey == geo.n_nationkey, "left")
                .select("s_suppkey", "s_name", (F.col("s_acctbal") + 0.0).alias("s_acctbal"), "r_name"))
    return cat.memo("supplier_geo", build)


def ranked_suppliers(cat: Catalog) -> DataFrame:
    """Suppliers with a world rank by balance (desc), key as tie-break.
    Global order without a single-task window (see operators.sequence)."""
    def build(c: Catalog) -> DataFrame:
        g = supplier_geo(c)
        r = sequence_index(g, [], [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()], out="_pos")
        return r.withColumn("base_rank", (F.col("_pos") + 1).cast("bigint")).drop("_pos")
    return cat.memo("ranked_suppliers", build)


def raw_csapi_team_rankings(cat: Catalog) -> DataFrame:
    return cat.raw("raw_csapi_team_rankings", _csapi_team_rankings)


def _csapi_team_rankings(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        s = ranked_suppliers(c)
        key = F.col("s_suppkey")
        snaps = F.explode(F.array(
            F.struct(F.lit(RANKING_DATES[0]).alias("d"), F.lit(0).alias("bump")),
            F.struct(F.lit(RANKING_DATES[1]).alias("d"),
                     F.when(key % 4 == 0, F.lit(1)).otherwise(F.lit(0)).alias("bump")),
        )).alias("snap")
        wr = F.when(key % 10 != 9, F.col("base_rank") + F.col("snap.bump"))
        return s.select("*", snaps).select(
            key.cast("string").alias("team_id"),
            F.lit("csapi").alias("source"),
            F.col("s_name").alias("name"),
            F.when(key % 7 == 1, F.col("r_name")).when(key % 2 == 0, F.lit("Global")).alias("region"),
            wr.cast("bigint").alias("world_ranking"),
            F.floor("s_acctbal").cast("bigint").alias("vrs_points"),
            F.col("snap.bump").cast("bigint").alias("rank_diff"),
            F.lit(0).cast("bigint").alias("points_diff"),
            F.col("snap.d").alias("ranking_date"),
            F.concat(F.col("snap.d"), F.lit("T06:00:00")).alias("ingested_at"),
        )
    return build(cat)


def raw_liquipedia_teams(cat: Catalog) -> DataFrame:
    return cat.raw("raw_liquipedia_teams", _liquipedia_teams)


def _liquipedia_teams(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        g = supplier_geo(c)
        key = F.col("s_suppkey")
        loads = F.explode(F.when(key % 10 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        return (g.select("*", loads.alias("load"))
                .select(F.concat(F.lit("lp_"), key.cast("string")).alias("team_id"),
                        F.lit("liquipedia").alias("source"),
                        F.lower("s_name").alias("name"),
                        F.when(key % 5 == 0, F.col("r_name")).alias("region"),
                        F.lit(None).cast("bigint").alias("world_ranking"),
                        F.concat(F.lit("2026-05-0"), F.col("load").cast("string"), F.lit("T00:00:00"))
                        .alias("ingested_at")))
    return build(cat)


def raw_valve_team_regions(cat: Catalog) -> DataFrame:
    return cat.raw("raw_valve_team_regions", _valve_team_regions)


def _valve_team_regions(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        g = supplier_geo(c)
        key = F.col("s_suppkey")
        regions = F.when(key % 9 == 0, F.array(F.col("r_name"), F.lit("OTHER"))).otherwise(F.array(F.col("r_name")))
        name = (F.when(key % 3 != 0, F.concat(F.lit("Academy "), F.col("s_name")))
                .when(key % 2 == 0, F.concat(F.lit("Team "), F.col("s_name"))).otherwise(F.upper("s_name")))
        return (g.select("*", F.explode(F.array(*[F.lit(d) for d in RANKING_DATES])).alias("snapshot_date"))
                .select("*", F.explode(regions).alias("region_v"))
                .select(F.col("snapshot_date"),
                        name.alias("team_name"),
                        normalize_team_name(name).alias("normalized_team_name"),
                        F.col("region_v").alias("region"),
                        key.cast("bigint").alias("regional_rank"),
                        F.lit(None).cast("bigint").alias("global_rank"),
                        F.floor("s_acctbal").cast("bigint").alias("points"),
                        F.lit(None).cast("string").alias("roster"),
                        F.concat(F.lit("/team/"), key.cast("string")).alias("detail_path"),
                        F.lit("valve").alias("source")))
    return build(cat)


# --------------------------------------------------------------------------- matches

def lineitem_pairs(cat: Catalog) -> DataFrame:
    """Line 2k-1 (team a) against line 2k (team b) of an order.

    Lines are first reduced to one row per (order, line): newest ship date,
    then the other columns descending. Both steps are one aggregation on
    (order, pair): the odd and even winners are the largest of the rows of
    their own parity, with a map-side partial aggregate. The columns that a match
    is made of lead that order, so lines that differ in later ones only are as good.
    """
    def build(c: Catalog) -> DataFrame:
        li = c.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
        ord_ = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
        odd = (F.col("l_linenumber") % 2) == 1
        pairs = (li.groupBy("l_orderkey", ((F.col("l_linenumber") + 1) / 2).cast("int").alias("pair_no"))
                 .agg(F.max(F.when(odd, ord_)).alias("a"), F.max(F.when(~odd, ord_)).alias("b")))
        return pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull()
                            & (F.col("a.l_suppkey") != F.col("b.l_suppkey")))
    return cat.memo("lineitem_pairs", build)


def raw_matches_all(cat: Catalog) -> DataFrame:
    """All raw match rows of the three providers, stored partitioned by ``source``."""
    return cat.raw("raw_matches", _matches_all, partition_by=("source",))


def raw_matches_path(cat: Catalog) -> str:
    """The folder of the raw match rows."""
    return cat.raw_path("raw_matches", _matches_all, partition_by=("source",))


def _matches_all(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        p = lineitem_pairs(c)
        orders = c.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        part = c.table("part").select("p_partkey", "p_brand")
        m = (p.join(orders, p.l_orderkey == orders.o_orderkey)
             .join(part, F.col("a.l_partkey") == part.p_partkey, "left"))
        a_id = F.col("a.l_suppkey").cast("string")
        b_id = F.col("b.l_suppkey").cast("string")
        sa = F.col("a.l_quantity").cast("bigint")
        sb = F.col("b.l_quantity").cast("bigint")
        even = (F.col("l_orderkey") % 2) == 0
        return m.select(
            F.col("l_orderkey").cast("string").alias("match_id"),
            _case("o_orderstatus", ORDER_STATUS_SOURCE).alias("source"),
            a_id.alias("team_a_id"),
            b_id.alias("team_b_id"),
            F.when(sa > sb, a_id).when(sb > sa, b_id).alias("winner_id"),
            iso_date_text("o_orderdate").alias("played_at"),
            F.col("p_brand").alias("map_name"),
            sa.alias("score_a"),
            sb.alias("score_b"),
            ((sa > 15) & (sb > 15)).alias("is_overtime"),
            F.when(even, F.col("a.l_suppkey") % 60 + 1).cast("bigint").alias("team_a_ranking"),
            F.when(even, F.col("b.l_suppkey") % 60 + 1).cast("bigint").alias("team_b_ranking"),
        )
    return build(cat)


def raw_matches(cat: Catalog, source: str) -> DataFrame:
    return raw_matches_all(cat).filter(F.col("source") == source)


# --------------------------------------------------------------------------- players

def raw_player_rows(cat: Catalog) -> DataFrame:
    """Match-level player rows of the three providers plus profile rows,
    stored partitioned by ``source``."""
    return cat.raw("raw_players", _player_rows, partition_by=("source",))


def _player_rows(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        li = c.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
        part = c.table("part").select("p_partkey", "p_name", "p_size")
        j = li.join(part, li.l_partkey == part.p_partkey, "left")
        kills = F.col("l_quantity")
        deaths = (F.col("l_linenumber") * 5).cast("double")
        src = _case("l_returnflag", RETURNFLAG_SOURCE)
        rows = j.select(
            F.col("l_partkey").cast("string").alias("player_id"),
            src.alias("source"),
            F.col("p_name").alias("display_name"),
            F.col("l_suppkey").cast("string").alias("team_id"),
            team_name_of(F.col("l_suppkey").cast("string")).alias("team_name"),
            F.lit(None).cast("string").alias("nationality"),
            kills.alias("kills"),
            deaths.alias("deaths"),
            F.try_divide(F.col("l_extendedprice"), F.nullif(kills, F.lit(0.0))).alias("adr"),
            F.try_divide(kills, F.nullif(deaths, F.lit(0.0))).alias("kd_ratio"),
            ((1 - (F.col("l_discount") + 0.0)) * 100).alias("kast"),
            (1 + (F.col("l_tax") + 0.0)).alias("rating"),
            F.lit(None).cast("double").alias("swing"),
            F.lit(None).cast("bigint").alias("matches_played"),
            F.when(src == "faceit", F.col("p_size") * 100).cast("bigint").alias("elo"),
            F.col("l_orderkey").cast("string").alias("match_id"),
            iso_date_text("l_shipdate").alias("recorded_at"),
        )
        profiles = c.table("part").select(
            F.col("p_partkey").cast("string").alias("player_id"),
            F.lit("pandascore").alias("source"),
            F.col("p_name").alias("display_name"),
            *[F.lit(None).cast(t).alias(n) for n, t in [
                ("team_id", "string"), ("team_name", "string"), ("nationality", "string"),
                ("kills", "double"), ("deaths", "double"), ("adr", "double"), ("kd_ratio", "double"),
                ("kast", "double"), ("rating", "double"), ("swing", "double"),
                ("matches_played", "bigint"), ("elo", "bigint"), ("match_id", "string")]],
            F.lit(PROFILE_DATE).alias("recorded_at"),
        )
        return rows.unionByName(profiles)
    return build(cat)


_PLAYER_COLS = ["player_id", "source", "display_name", "team_id", "nationality", "kills", "deaths", "adr",
                "kd_ratio", "kast", "elo", "match_id", "recorded_at"]


def raw_faceit_players(cat: Catalog) -> DataFrame:
    r = raw_player_rows(cat).filter(F.col("source") == "faceit")
    return r.select(*[F.col(c).cast("bigint").alias(c) if c in ("kills", "deaths") else F.col(c)
                      for c in _PLAYER_COLS])


def raw_pandascore_players(cat: Catalog) -> DataFrame:
    r = raw_player_rows(cat).filter(F.col("source") == "pandascore")
    return r.select(*[F.col(c).cast("bigint").alias(c) if c in ("kills", "deaths") else F.col(c)
                      for c in _PLAYER_COLS])


def raw_csapi_player_stats(cat: Catalog) -> DataFrame:
    r = raw_player_rows(cat).filter((F.col("source") == "csapi") & F.col("match_id").isNotNull())
    return r.select("player_id", "source", "display_name", "team_id", "team_name", "nationality", "kills",
                    "deaths", "adr", "kd_ratio", "kast", "rating", "swing", "matches_played", "elo",
                    "match_id", "recorded_at")


# --------------------------------------------------------------------------- rounds

def raw_hltv_round_history(cat: Catalog) -> DataFrame:
    """Events of a user in time order are rounds; a map is a run of 24, 27, 30
    or 33 of them (longer maps go to overtime)."""
    return cat.raw("raw_hltv_round_history", _round_history)


def _round_history(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        ev = c.table("events").select("event_id", "ts", "user_id", "event_type")
        idx = sequence_index(ev, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()], out="i")
        u = F.col("user_id")
        length = 24 + (u % 4) * 3
        map_no = (F.col("i") / length).cast("long")
        r = idx.select("*", map_no.alias("map_no"),
                       ((F.col("i") % length) + 1).cast("long").alias("round_number"),
                       (u % 10).cast("string").alias("team1_id"),
                       ((u + 1 + map_no % 9) % 10).cast("string").alias("team2_id"))  # never team1
        rn = F.col("round_number")
        start_ct = ((u + F.col("map_no")) % 2) == 0
        ot_chunk_even = (((rn - 25) / 3).cast("long") % 2) == 0
        team1_ct = (F.when(rn <= 12, start_ct).when(rn <= 24, ~start_ct)
                    .otherwise(F.when(ot_chunk_even, start_ct).otherwise(~start_ct)))
        t1_won = F.col("event_type").isin("click", "view") | (
            (F.col("event_type") == "purchase") & ((F.col("event_id") % 2) == 0))
        r = r.select("*", team1_ct.alias("t1_ct"), t1_won.alias("t1_won"))
        ct_id = F.when(F.col("t1_ct"), F.col("team1_id")).otherwise(F.col("team2_id"))
        t_id = F.when(F.col("t1_ct"), F.col("team2_id")).otherwise(F.col("team1_id"))
        win_id = F.when(F.col("t1_won"), F.col("team1_id")).otherwise(F.col("team2_id"))
        win_side = F.when(win_id == ct_id, F.lit("ct")).otherwise(F.lit("t"))
        purchase = F.col("event_type") == "purchase"
        outcome = (F.when(win_side == "ct", F.when(purchase, F.lit("bomb_defused")).otherwise(F.lit("ct_win")))
                   .otherwise(F.when(purchase, F.lit("bomb_exploded")).otherwise(F.lit("t_win"))))
        map_id = F.concat(u.cast("string"), F.lit("-"), F.col("map_no").cast("string"))
        from pyspark.sql import Window
        w = Window.partitionBy("map_stats_id").orderBy("round_number").rowsBetween(Window.unboundedPreceding, 0)
        r = r.select("*", map_id.alias("map_stats_id"))
        s1 = F.sum(F.col("t1_won").cast("long")).over(w)
        r = r.select("*", s1.alias("s1"))
        return r.select(
            F.lit("hltv_unofficial").alias("source"),
            F.col("map_stats_id"),
            F.concat(u.cast("string"), F.lit("-"), (F.col("map_no") / 3).cast("long").cast("string")).alias("match_id"),
            F.concat(F.lit("e"), (u % 5).cast("string")).alias("event_id"),
            F.concat(F.lit("Event "), (u % 5).cast("string")).alias("event_name"),
            F.concat(F.lit("Map"), ((u + F.col("map_no")) % 7).cast("string")).alias("map_name"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("played_at"),
            rn.alias("round_number"),
            t_id.alias("t_team_id"), team_name_of(t_id).alias("t_team_name"),
            ct_id.alias("ct_team_id"), team_name_of(ct_id).alias("ct_team_name"),
            win_side.alias("winner_side"),
            win_id.alias("winner_team_id"), team_name_of(win_id).alias("winner_team_name"),
            F.col("team1_id"), team_name_of(F.col("team1_id")).alias("team1_name"),
            F.col("team2_id"), team_name_of(F.col("team2_id")).alias("team2_name"),
            F.col("s1").alias("score_team1_after"),
            (rn - F.col("s1")).alias("score_team2_after"),
            F.when(rn % 6 == 0, F.concat(F.col("s1").cast("string"), F.lit("-"),
                                         (rn - F.col("s1")).cast("string"))).alias("reported_score"),
            outcome.alias("round_outcome"),
            (rn > 24).alias("is_overtime"),
            F.lit(ROUND_LOADED_AT).alias("ingested_at"),
        )
    return build(cat)
