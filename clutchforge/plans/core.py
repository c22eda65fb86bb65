"""Star schema: dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import RANKING_SOURCE_PRIORITY, normalize_team_name, surrogate_key
from ..operators.dedupe import (asc_nulls_last, desc_nulls_first, desc_nulls_last, keep_first,
                                keep_first_laid_out, keep_unambiguous, keep_unique)
from ..operators.joins import broadcast_if_small, one_row
from .. import schemas
from ..session import shuffle_tasks
from ..sources.tables import Catalog
from ..streaming.merge import KeyedTable, merge_load
from . import staging as stg


def dim_maps(cat: Catalog) -> DataFrame:
    m = stg.int_matches_unioned(cat).select("map_name").where(F.col("map_name").isNotNull()).distinct()
    return m.select(surrogate_key("map_name").alias("map_sk"), "map_name")


def players(cat: Catalog) -> DataFrame:
    """``int_players_unioned``, stored: its dedupe moves every player row, and the dimension, the fact and the rules read it.
    Rows of a player lie together (a player of very many is cut by match), so what is summed per player is combined map-side."""
    def build(c: Catalog) -> DataFrame:
        return keep_first_laid_out(stg.players_unioned_raw(c), stg.player_grain(), stg.first_provider(), shuffle_tasks(c.spark))
    return cat.raw("core_int_players", build)


def dim_players(cat: Catalog) -> DataFrame:
    """Latest row per player (recorded_at desc; warehouse DESC puts nulls first)."""
    def build(c: Catalog) -> DataFrame:
        # Of rows of one time the largest stays; no other column comes before these or tells apart what is read of them.
        p = players(c).select("player_id", "source", "display_name", "team_id", "nationality", "recorded_at")
        latest = keep_first(p, ["player_id"], desc_nulls_first(F.col("recorded_at")))
        return latest.select("player_id", "display_name", "team_id", "nationality",
                             F.col("source").alias("primary_source"), F.col("recorded_at").alias("last_updated"))
    return cat.memo("dim_players", build)


def liquipedia_region_names(cat: Catalog) -> DataFrame:
    """Normalised liquipedia name -> region, only names seen exactly once."""
    lq = stg.stg_liquipedia_teams(cat).where(F.col("name").isNotNull() & F.col("region").isNotNull())
    return keep_unique(lq.select(normalize_team_name("name").alias("normalized_team_name"), "region"),
                       ["normalized_team_name"], ["region"])


def latest_valve_regions(cat: Catalog) -> DataFrame:
    """Valve rows of the newest snapshot date (the max is a one-row aggregate)."""
    v = stg.stg_valve_team_regions(cat)
    latest = one_row(v.agg(F.max("snapshot_date").alias("snapshot_date")))
    return (v.join(latest, "snapshot_date")
            .where(F.col("normalized_team_name").isNotNull() & F.col("region").isNotNull())
            .select("team_name", "normalized_team_name", "region"))


def exact_valve_region_names(cat: Catalog) -> DataFrame:
    v = latest_valve_regions(cat).where(F.col("team_name").isNotNull())
    return keep_unambiguous(v.withColumn("team_name_key", F.lower("team_name")), ["team_name_key"], "region")


def valve_region_names(cat: Catalog) -> DataFrame:
    return keep_unambiguous(latest_valve_regions(cat), ["normalized_team_name"], "region")


def csapi_team_rows(cat: Catalog) -> DataFrame:
    """csapi ranking rows with the region cascade: own region unless 'global',
    then liquipedia by normalised name, valve by exact name, valve by normalised name."""
    c = stg.stg_csapi_team_rankings(cat).withColumn("_norm", normalize_team_name("name"))
    lr = broadcast_if_small(liquipedia_region_names(cat)).select(
        F.col("normalized_team_name").alias("_lr_key"), F.col("region").alias("_lr_region"))
    ev = broadcast_if_small(exact_valve_region_names(cat)).select(
        F.col("team_name_key").alias("_ev_key"), F.col("region").alias("_ev_region"))
    vr = broadcast_if_small(valve_region_names(cat)).select(
        F.col("normalized_team_name").alias("_vr_key"), F.col("region").alias("_vr_region"))
    j = (c.join(lr, c["_norm"] == lr["_lr_key"], "left")
         .join(ev, F.lower(c["name"]) == ev["_ev_key"], "left")
         .join(vr, c["_norm"] == vr["_vr_key"], "left"))
    own = F.when(F.lower(F.col("region")) == "global", F.lit(None)).otherwise(F.col("region"))
    return j.select(
        "team_id",
        F.col("name").alias("team_name"),
        F.coalesce(own, "_lr_region", "_ev_region", "_vr_region").alias("region"),
        "world_ranking",
        F.col("ranking_date").alias("last_updated"),
        F.lit("csapi").alias("ranking_source"),
        F.lit(RANKING_SOURCE_PRIORITY["csapi"]).alias("ranking_source_priority"),
    )


def dim_teams(cat: Catalog) -> DataFrame:
    """One row per team: liquipedia before csapi, newest first, best rank first."""
    def build(c: Catalog) -> DataFrame:
        lq = stg.stg_liquipedia_teams(c).select(
            "team_id", F.col("name").alias("team_name"), "region", "world_ranking",
            F.col("ingested_at").alias("last_updated"), F.lit("liquipedia").alias("ranking_source"),
            F.lit(RANKING_SOURCE_PRIORITY["liquipedia"]).alias("ranking_source_priority"))
        u = lq.unionByName(csapi_team_rows(c))
        order = ([-F.col("ranking_source_priority")] + desc_nulls_first(F.col("last_updated"))
                 + asc_nulls_last(F.col("world_ranking")))
        best = keep_first(u, ["team_id"], order)
        return best.select("team_id", "team_name", "region", "world_ranking", "ranking_source", "last_updated")
    return cat.memo("dim_teams", build)


def fact_matches(cat: Catalog) -> DataFrame:
    """One row per (match, source, map): newest played_at (parsed; unparsable
    last), then the whole row as tie-break.

    ``map_sk`` is the surrogate key of ``map_name``; every non-null map name
    of the fact is in ``dim_maps`` by construction, so the key is computed
    in place instead of joining the dimension back (same result, no join).
    """
    def build(c: Catalog) -> DataFrame:
        m = stg.int_matches_unioned(c)
        return _fact_rows(keep_first(m, MATCH_GRAIN, newest_match(m)))
    return cat.memo("fact_matches", build)


MATCH_GRAIN = ["match_id", "source", "map_name"]
MATCH_BUCKETS = 32  # of the merged match table; a property of the table, whatever the session's settings


def newest_match(m: DataFrame) -> list[Column]:
    """The order that picks a match row of its grain: newest ``played_at`` (then the whole row, as ``keep_first`` does)."""
    return desc_nulls_last(F.col("played_at").try_cast("date"))


def _fact_rows(d: DataFrame) -> DataFrame:
    return d.select(
        surrogate_key(*MATCH_GRAIN).alias("match_sk"),
        "match_id", "source", "team_a_id", "team_b_id", "winner_id",
        F.when(F.col("map_name").isNotNull(), surrogate_key("map_name")).alias("map_sk"),
        "map_name", "played_at", "score_a", "score_b", "is_overtime", "team_a_ranking", "team_b_ranking")


def match_table(cat: Catalog, path: str) -> KeyedTable:
    """The match rows at fact grain that loads are merged into."""
    schema = stg.int_matches_unioned(cat).schema
    return KeyedTable(cat.spark, path, schema, MATCH_GRAIN, newest_match, MATCH_BUCKETS)


def load_matches(cat: Catalog, landing: str, table: KeyedTable, checkpoint: str) -> None:
    """Merge the raw match files that haven't been loaded yet into ``table``."""
    merge_load(cat.spark, landing, schemas.RAW_MATCHES, stg.staged_matches, table, checkpoint)


def fact_of_loads(table: KeyedTable) -> DataFrame:
    """``fact_matches`` from the merged rows: no dedupe is left to do."""
    return _fact_rows(table.read())


def fact_player_stats(cat: Catalog) -> DataFrame:
    def build(c: Catalog) -> DataFrame:
        p = players(c).where(F.col("match_id").isNotNull())
        kills, deaths = F.col("kills").cast("double"), F.col("deaths").cast("double")
        return p.select(
            surrogate_key("player_id", "match_id", "source").alias("player_stat_sk"),
            "player_id", "source", "display_name", "team_id", "match_id", "kills", "deaths", "adr",
            "kd_ratio", "kast", "rating", "elo", "recorded_at",
            F.when(deaths > 0, kills / deaths).alias("computed_kd"),
            F.when((kills + deaths) > 0, kills / (kills + deaths)).alias("kill_share"),
        )
    return cat.memo("fact_player_stats", build)


# ----------------------------------------------------------------------------- materialised core
CORE_TABLES = {
    "dim_teams": dim_teams,
    "dim_players": dim_players,
    "fact_matches": fact_matches,
    "fact_player_stats": fact_player_stats,
}
VIEWS = ("fact_player_stats",)  # of ``players``


def table(cat: Catalog, name: str) -> DataFrame:
    """A core table as the marts read it: built once per input and code version
    and stored as Parquet (the reference materialises dims and facts as tables,
    staging stays a view); ``VIEWS`` are projections of a stored table and not written
    a second time. The registered ``dim_*`` / ``fact_*`` queries run the builders themselves."""
    if name in VIEWS:
        return CORE_TABLES[name](cat)
    return cat.raw(f"core_{name}", CORE_TABLES[name])
