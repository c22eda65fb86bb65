"""Which objects earlier loads have written: a commit log of their keys.

A load writes its rows first and its keys last, both under its own id. So a key is in the
manifest only when its rows are there, a load that dies before its commit is offered
again whole, and running it again under the same id replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import append_batch
from ..sources import hadoop

SCHEMA = "object_key string, load_id string"


class LoadManifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def loaded(self) -> DataFrame:
        """object_key and load_id of every committed object."""
        if not hadoop.folders(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema("object_key string, batch_id string").option("basePath", self.path).parquet(self.path) \
            .withColumnRenamed("batch_id", "load_id")

    def pending(self, rows: DataFrame, load_id: str | None = None) -> DataFrame:
        """The rows (object_key, ...) whose key no load (but ``load_id`` itself) has committed."""
        done = self.loaded() if load_id is None else self.loaded().where(F.col("load_id") != load_id)
        return rows.join(done.select("object_key").distinct(), "object_key", "left_anti")

    def commit(self, keys: DataFrame, load_id: str) -> None:
        append_batch(keys.select("object_key").distinct(), self.path, load_id)


def load_pending(rows: DataFrame, target: str, manifest: LoadManifest, load_id: str) -> None:
    """Write the rows of keys that are not loaded yet under ``batch_id=<load_id>`` of ``target``, then commit the keys.
    (The keys are taken from what was written.)"""
    spark = rows.sparkSession
    if append_batch(manifest.pending(rows, load_id), target, load_id):
        schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.StringType())])
        written = spark.read.schema(schema).option("basePath", target).parquet(target).where(F.col("batch_id") == load_id)
        manifest.commit(written, load_id)
