"""Ranking snapshots, as-of lookups and load bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import asof_lookup
from ..operators.sequence import sequence_index
from ..sources.tables import Catalog
from ..streaming.manifest import LoadManifest, load_pending
from . import core

ASOF_MAX_DAYS_BACK = 15   # the day before the match, then up to 14 more days
ASOF_MIN_DAYS_BACK = 1
SNAPSHOT_KINDS = ("americas", "asia", "europe", "global")
PRIORITY_KIND = {"1-URGENT": "americas", "2-HIGH": "asia", "3-MEDIUM": "europe",
                 "4-NOT SPECIFIED": "global", "5-LOW": "global"}
PROFILE_CAPS = {"daily": 150, "weekly": 3000, "backfill": 10000}


def monthly_rankings(cat: Catalog) -> DataFrame:
    """Ranking snapshot per month: suppliers ranked by shipped revenue
    (desc, key asc); snapshot date = first day of the month. Ranks are placed
    with the skew-safe sequence operator (a month is one group)."""
    def build(c: Catalog) -> DataFrame:
        li = c.table("lineitem").select("l_suppkey", "l_extendedprice", "l_shipdate")
        rev = (li.groupBy(F.trunc("l_shipdate", "month").alias("ranking_date"), "l_suppkey")
               .agg(F.sum(F.col("l_extendedprice").cast("decimal(28,2)")).alias("revenue")))
        ranked = sequence_index(rev, ["ranking_date"], [F.col("revenue").desc(), F.col("l_suppkey").asc()],
                                out="_pos")
        return ranked.select("ranking_date", F.col("l_suppkey").cast("string").alias("team_id"),
                             (F.col("_pos") + 1).cast("bigint").alias("rank"))
    return cat.memo("monthly_rankings", build)


def asof_ranking(cat: Catalog) -> DataFrame:
    """Each csapi match with both teams' rank from the newest snapshot dated
    1-15 days before the match; no snapshot or team missing -> null."""
    m = core.table(cat, "fact_matches").where(F.col("source") == "csapi").select(
        "match_id", "map_name", "team_a_id", "team_b_id", F.col("played_at").try_cast("date").alias("match_date"))
    r = monthly_rankings(cat)
    m = asof_lookup(m, F.col("match_date"), r, "ranking_date", ASOF_MAX_DAYS_BACK, ASOF_MIN_DAYS_BACK,
                    out_col="asof_date")
    ra = r.select(F.col("ranking_date").alias("_da"), F.col("team_id").alias("_ta"), F.col("rank").alias("team_a_rank"))
    rb = r.select(F.col("ranking_date").alias("_db"), F.col("team_id").alias("_tb"), F.col("rank").alias("team_b_rank"))
    j = (m.join(ra, (m["asof_date"] == ra["_da"]) & (m["team_a_id"] == ra["_ta"]), "left")
         .join(rb, (m["asof_date"] == rb["_db"]) & (m["team_b_id"] == rb["_tb"]), "left"))
    return j.select("match_id", "map_name", "team_a_id", "team_b_id", "match_date", "asof_date",
                    "team_a_rank", "team_b_rank")


def snapshot_listing(cat: Catalog) -> DataFrame:
    """A file listing as a table: one standings file per (date, kind) seen in orders."""
    o = cat.table("orders").select("o_orderdate", "o_orderpriority")
    kind = None
    for p, k in PRIORITY_KIND.items():
        kind = F.when(F.col("o_orderpriority") == p, F.lit(k)) if kind is None else kind.when(
            F.col("o_orderpriority") == p, F.lit(k))
    files = o.select(F.concat(F.lit("standings_"), kind, F.lit("_"),
                              F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit(".md")).alias("filename"))
    return files.where(F.col("filename").isNotNull()).distinct()


def latest_complete_snapshot(cat: Catalog) -> DataFrame:
    """Newest date of the newest year whose four kinds of file are all present."""
    return latest_complete_from_listing(snapshot_listing(cat))


def latest_complete_from_listing(listing: DataFrame) -> DataFrame:
    """``listing(filename)`` -> one row (snapshot_date, complete_dates)."""
    pat = r"^standings_([a-z]+)_(\d{4})_(\d{2})_(\d{2})\.md$"
    f = listing.select(
        F.regexp_extract("filename", pat, 1).alias("kind"),
        F.regexp_extract("filename", pat, 2).try_cast("int").alias("year"),
        F.to_date(F.concat_ws("-", F.regexp_extract("filename", pat, 2), F.regexp_extract("filename", pat, 3),
                              F.regexp_extract("filename", pat, 4))).alias("snapshot_date"))
    f = f.where(F.col("kind").isin(*SNAPSHOT_KINDS) & F.col("year").isNotNull())
    latest_year = f.agg(F.max("year").alias("year"))
    per_date = (f.join(F.broadcast(latest_year), "year")
                .groupBy("snapshot_date").agg(F.count_distinct("kind").alias("kinds")))
    complete = per_date.where(F.col("kinds") == len(SNAPSHOT_KINDS))
    return complete.agg(F.max("snapshot_date").alias("snapshot_date"),
                        F.count(F.lit(1)).alias("complete_dates"))


def match_window(cat: Catalog, profile: str = "daily", offset: int = 0) -> DataFrame:
    """Newest matches of a load profile: skip ``offset``, keep at most the cap."""
    cap = PROFILE_CAPS[profile]
    m = core.table(cat, "fact_matches")
    ordered = m.orderBy(F.col("played_at").desc(), F.col("match_id").desc(), F.col("source").asc(),
                        F.col("map_name").asc_nulls_last())
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(cap).select("match_sk", "match_id", "source", "map_name", "played_at")


def batch_keys(cat: Catalog) -> DataFrame:
    """Object keys a load would write: one per (source, played date)."""
    m = core.table(cat, "fact_matches").select("source", F.col("played_at").try_cast("date").alias("d")).distinct()
    key = F.concat(F.lit("raw/"), F.col("source"), F.lit("/matches/year="), F.date_format("d", "yyyy"),
                   F.lit("/month="), F.date_format("d", "MM"), F.lit("/day="), F.date_format("d", "dd"),
                   F.lit("/matches.parquet"))
    return m.where(F.col("d").isNotNull()).select("source", "d", key.alias("object_key"))


def matches_by_key(cat: Catalog) -> DataFrame:
    """Fact rows with the key of the object that a load would write them to."""
    m = core.table(cat, "fact_matches").withColumn("d", F.col("played_at").try_cast("date"))
    return m.select("match_sk", "source", "d").join(batch_keys(cat), ["source", "d"])


def second_load(cat: Catalog, folder: str, first_until: str = "1995-06-30") -> tuple[LoadManifest, str]:
    """Two loads into ``folder``: the first of what was played up to a day (and all of one provider), the
    second of everything there is. The manifest, and the second load's id."""
    rows = matches_by_key(cat)
    manifest = LoadManifest(cat.spark, f"{folder}/manifest")
    early = rows.where((F.col("d") <= F.lit(first_until).cast("date")) | (F.col("source") == "pandascore"))
    load_pending(early, f"{folder}/matches", manifest, "load-1")
    load_pending(rows, f"{folder}/matches", manifest, "load-2")
    return manifest, "load-2"


def selection_semi_join(cat: Catalog, regions: tuple[str, ...] = ("EUROPE", "ASIA", "AFRICA")) -> DataFrame:
    """Matches where either side's region is in a selection table."""
    from . import marts
    u = marts.table(cat, "mart_upset_features")
    # the selection is a short UI list, so an IN list (no join) is the plan
    cond = F.col("team_a_region").isin(*regions) | F.col("team_b_region").isin(*regions)
    return u.where(cond).select("match_sk", "match_id", "team_a_region", "team_b_region")
