"""Models in the catalog: staging and intermediate models as views, marts as tables.

A mart is written to a folder of its own, then the table is pointed at it in one catalog
call. Whoever is still reading the version before goes on reading its files; they go
only with ``expire``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources import hadoop

STAGING, MARTS = "staging", "marts"  # fixed schema names


def view_name(model: str) -> str:
    return f"{STAGING}_{model}"


def publish_view(df: DataFrame, model: str) -> str:
    """A staging or intermediate model: a view, nothing is stored."""
    df.createOrReplaceTempView(view_name(model))
    return view_name(model)


def publish_table(df: DataFrame, model: str, warehouse: str) -> str:
    """Write a mart and make it the version that readers of ``marts.<model>`` get from now on."""
    spark = df.sparkSession
    folder = f"{warehouse.rstrip('/')}/{MARTS}/{model}/{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(folder)
    spark.sql(f"create database if not exists {MARTS} location '{hadoop.locate(spark, warehouse)[0].toString()}/{MARTS}'")
    table = f"{MARTS}.{model}"
    if spark.catalog.tableExists(table) and spark.table(table).schema == spark.read.parquet(folder).schema:
        spark.sql(f"alter table {table} set location '{hadoop.locate(spark, folder)[0].toString()}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"drop table if exists {table}")
        spark.catalog.createTable(table, path=folder, source="parquet")
    return table


def location(spark: SparkSession, model: str) -> str:
    """The folder that holds the current version of a mart."""
    rows = spark.sql(f"describe table extended {MARTS}.{model}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def expire(spark: SparkSession, model: str, warehouse: str) -> list[str]:
    """Remove the versions of a mart that are not current; their folder names."""
    top = f"{warehouse.rstrip('/')}/{MARTS}/{model}"
    current = location(spark, model).rstrip("/").rsplit("/", 1)[-1]
    old = [f for f in hadoop.folders(spark, top) if f != current]
    for f in old:
        hadoop.remove(spark, f"{top}/{f}")
    return old
