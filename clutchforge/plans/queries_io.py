"""Registered queries for sources, sinks and the incremental load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas, sinks
from ..sinks import warehouse
from ..sources import raw_io
from ..sources import standins as raw
from ..sources.tables import Catalog
from ..streaming.incremental import incremental_load
from . import core, marts, ml
from . import staging as stg
from .registry import query


def _raw_matches_path(cat: Catalog) -> str:
    return raw.raw_matches_path(cat)


@query("scan_parquet")
def q_scan_parquet(cat: Catalog) -> DataFrame:
    """SRC-01/02: typed scan of a partitioned raw prefix with the contract schema."""
    p = _raw_matches_path(cat)
    return raw_io.scan_raw(cat.spark, p, schemas.RAW_MATCHES)


@query("partition_pruned_scan")
def q_partition_pruned_scan(cat: Catalog) -> DataFrame:
    """SRC-05: only the csapi partition is listed and read (PartitionFilters)."""
    p = _raw_matches_path(cat)
    return raw_io.scan_raw(cat.spark, p, schemas.RAW_MATCHES).where(F.col("source") == "csapi")


@query("data_freshness")
def q_data_freshness(cat: Catalog) -> DataFrame:
    """SNK-06: rows and newest file time per raw table."""
    f = raw_io.freshness({
        "raw_matches": raw.raw_matches_all(cat),
        "raw_players": raw.raw_player_rows(cat),
        "raw_csapi_team_rankings": raw.raw_csapi_team_rankings(cat),
        "raw_hltv_round_history": raw.raw_hltv_round_history(cat),
    })
    return f.select("product", "row_count", F.col("loaded_at").isNotNull().alias("has_loaded_at"))


@query("incremental_load")
def q_incremental_load(cat: Catalog) -> DataFrame:
    """SRC-03 / STR-01: exactly-once file load; the result is the loaded table
    (a second run adds nothing, so it always equals the source files)."""
    def load(folder: str) -> None:
        for _ in range(2):
            incremental_load(cat.spark, _raw_matches_path(cat), f"{folder}/rows", f"{folder}/checkpoint", schemas.RAW_MATCHES)

    return cat.spark.read.parquet(cat.stored("loaded_matches", load) + "/rows").drop("batch_id")


# Days between which the raw matches of a load were played. The loads overlap.
MATCH_LOADS = (("1900-01-01", "1995-06-30"), ("1994-07-01", "1997-03-31"), ("1996-10-01", "9999-12-31"))


@query("merge_fact_matches")
def q_merge_fact_matches(cat: Catalog) -> DataFrame:
    """STR-02: the match fact from a table that three overlapping loads were merged into, one of them twice."""
    def load(folder: str) -> None:
        landing, table = f"{folder}/landing", core.match_table(cat, f"{folder}/matches")
        raw_rows = raw.raw_matches_all(cat)
        loads = [raw_rows.where(F.coalesce(F.col("played_at"), F.lit("1900-01-01")).between(*days)) for days in MATCH_LOADS]
        for rows in loads:
            rows.write.mode("append").parquet(landing)
            core.load_matches(cat, landing, table, f"{folder}/checkpoint")
        table.merge(stg.staged_matches(loads[1]))  # a load that comes again

    path = cat.stored("merged_matches", load)
    return core.fact_of_loads(core.match_table(cat, f"{path}/matches"))


@query("snapshot_roundtrip")
def q_snapshot_roundtrip(cat: Catalog) -> DataFrame:
    """SNK-05 / SRC-09: export a mart snapshot (warehouse-style upper-case names),
    read it back with lower-case column names."""
    m = marts.mart_team_performance(cat)
    path = cat.stored("snapshot_team_performance", lambda folder: sinks.export_snapshot(
        m.toDF(*[c.upper() for c in m.columns]), folder))
    return sinks.read_snapshot(cat.spark, path)


def _with_text(schema: T.StructType, *columns: str) -> T.StructType:
    """A schema and text columns, those of partition folders."""
    return T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in columns]])


@query("sink_date_partitions")
def q_sink_date_partitions(cat: Catalog) -> DataFrame:
    """SNK-01: rankings written under year / month / day of their date with the contract's columns, then read back."""
    def write(folder: str) -> None:
        sinks.write_date_partitioned(raw.raw_csapi_team_rankings(cat), folder, "ranking_date", schemas.RAW_CSAPI_TEAM_RANKINGS)

    path = cat.stored("ranking_files", write)
    return raw_io.scan_raw(cat.spark, path, _with_text(schemas.RAW_CSAPI_TEAM_RANKINGS, "year", "month", "day"))


@query("sink_batches")
def q_sink_batches(cat: Catalog) -> DataFrame:
    """SNK-02 / SNK-03: one batch per region, all of them written twice, and a first write that a second doesn't replace."""
    rows = raw.raw_valve_team_regions(cat)

    def write(folder: str) -> None:
        regions = [r["region"] for r in rows.select("region").distinct().collect()]  # a handful
        for region in regions + regions:
            sinks.append_batch(rows.where(F.col("region") == region), f"{folder}/batches", region.replace(" ", "_"))
        sinks.write_if_absent(rows, f"{folder}/once")
        sinks.write_if_absent(rows.unionByName(rows), f"{folder}/once")

    path = cat.stored("region_batches", write)
    batches = cat.spark.read.schema(_with_text(rows.schema, "batch_id")).parquet(f"{path}/batches")
    once = cat.spark.read.schema(rows.schema).parquet(f"{path}/once").withColumn("batch_id", F.lit("once"))
    return batches.unionByName(once).groupBy("batch_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("points").alias("points"))


@query("sink_metrics")
def q_sink_metrics(cat: Catalog) -> DataFrame:
    """SNK-07: the model's threshold rows persisted and read back."""
    t = ml.validation_threshold(cat)
    path = cat.stored("threshold_rows", lambda folder: sinks.write_metrics(t, folder))
    return cat.spark.read.schema(t.schema).json(path)


@query("warehouse_objects")
def q_warehouse_objects(cat: Catalog) -> DataFrame:
    """SNK-04: staging models as views, marts as tables that are replaced under their readers; rows as the catalog serves them."""
    top = f"{cat.raw_store}/warehouse"
    views = {"stg_csapi_team_rankings": stg.stg_csapi_team_rankings, "stg_liquipedia_teams": stg.stg_liquipedia_teams,
             "stg_hltv_round_history": stg.stg_hltv_round_history, "int_matches_unioned": stg.int_matches_unioned}
    tables = {"mart_team_performance": marts.mart_team_performance, "mart_head2head": marts.mart_head2head,
              "mart_map_meta": marts.mart_map_meta}
    out = [(warehouse.publish_view(build(cat), model), model, "view") for model, build in views.items()]
    for model, build in tables.items():
        warehouse.publish_table(build(cat).limit(0), model, top)  # the version before
        out.append((warehouse.publish_table(build(cat), model, top), model, "table"))
    rows = [cat.spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(model).alias("model"), F.lit(kind).alias("kind"), "row_count") for name, model, kind in out]
    return reduce(DataFrame.unionByName, rows)
