"""A keyed Parquet table that loads are merged into: one row per key, the newest.

Rows lie in ``buckets`` folders by the hash of their key. A merge keeps the best row of each key
of the batch (an aggregate with a map-side step, so a key's copies collapse before the
shuffle), reads the buckets these keys fall into, keeps the best of both and overwrites
only those buckets. Keeping the best row is idempotent: a batch that comes again,
whole or in part, changes nothing, and loads may overlap or arrive in any order.

A merge that is cut off does no harm. Until its result is written whole beside the table,
the table is as before; from then on a marker names the result. Readers take the buckets it
has from there, and the next merge first puts it in place again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import keep_first
from ..sources import hadoop

BUCKETS = 64


class KeyedTable:
    """``ordering(rows)`` gives the columns whose largest struct picks a key's row (see
    operators.dedupe); equal ones are told apart by the whole row, so the pick doesn't depend on the order of loads."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                 ordering: Callable[[DataFrame], list[Column]], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.ordering, self.buckets = spark, path, schema, keys, ordering, buckets
        self.rows, self.staging, self.pending = f"{path}/rows", f"{path}/staging", f"{path}/pending"

    def read(self) -> DataFrame:
        rows = self._read()
        result = hadoop.read_marker(self.spark, self.pending)
        if result is not None:
            new = self.spark.read.parquet(result)
            rows = rows.where(~F.col("bucket").isin(self._buckets_of(new))).unionByName(new)
        return rows.drop("bucket")

    @staticmethod
    def _buckets_of(rows: DataFrame) -> list[int]:
        return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # at most ``buckets`` numbers

    def _read(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        if not hadoop.folders(self.spark, self.rows):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.rows).parquet(self.rows)

    def recover(self) -> None:
        """Finish a merge that was cut off after its result was there."""
        result = hadoop.read_marker(self.spark, self.pending)
        if result is not None:
            self._publish(result)

    def _publish(self, result: str) -> None:
        """Overwrite the buckets of ``result``, then forget it. May be done again."""
        self.spark.read.parquet(result).repartition("bucket").write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.rows)
        hadoop.remove(self.spark, self.pending)
        hadoop.remove(self.spark, result)

    def merge(self, batch: DataFrame) -> list[int]:
        """Merge a batch; the buckets that were written."""
        self.recover()
        place = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        batch = batch.select(*columns)
        incoming, result = f"{self.staging}/{uuid.uuid4().hex}", f"{self.staging}/{uuid.uuid4().hex}"
        keep_first(batch, self.keys, self.ordering(batch)).withColumn("bucket", place).write.parquet(incoming)
        new = self.spark.read.parquet(incoming)
        touched = self._buckets_of(new)
        if touched:
            both = self._read().where(F.col("bucket").isin(touched)).unionByName(new).drop("bucket")
            keep_first(both, self.keys, self.ordering(both)).withColumn("bucket", place).write.parquet(result)
            hadoop.write_marker(self.spark, self.pending, result)
            self._publish(result)
        hadoop.remove(self.spark, incoming)
        return touched


def merge_load(spark: SparkSession, source_dir: str, schema: T.StructType, prepare: Callable[[DataFrame], DataFrame],
               table: KeyedTable, checkpoint_dir: str, max_files_per_trigger: int | None = None) -> None:
    """Merge the raw files that haven't been loaded yet, each micro-batch once ``prepare`` has made rows of
    the table of it, then stop. The file log is in the checkpoint; a batch that is replayed after a failure changes nothing."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def merge_batch(batch: DataFrame, _: int) -> None:
        table.merge(prepare(batch))

    (reader.parquet(source_dir).writeStream.foreachBatch(merge_batch)
     .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination())
