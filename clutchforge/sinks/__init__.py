"""Writers for raw files, marts, snapshots and model artefacts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH_ID = re.compile(r"^[A-Za-z0-9_.-]+$")


def enforce_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract columns in order with their types; unknown columns are an error."""
    extra = sorted(set(df.columns) - {f.name for f in schema.fields})
    if extra:
        raise ValueError(f"columns outside the contract: {extra}")
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols)


def write_date_partitioned(df: DataFrame, path: str, date_col: str, schema: T.StructType | None = None,
                           mode: str = "append") -> None:
    """Snappy Parquet under year=YYYY/month=MM/day=DD (zero-padded) from ``date_col``."""
    out = enforce_contract(df, schema) if schema is not None else df
    d = F.to_date(F.col(date_col))
    out = out.select("*", F.date_format(d, "yyyy").alias("year"), F.date_format(d, "MM").alias("month"),
                     F.date_format(d, "dd").alias("day"))
    (out.write.mode(mode).option("compression", "snappy").partitionBy("year", "month", "day").parquet(path))


def write_if_absent(df: DataFrame, path: str) -> None:
    """Idempotent write: nothing happens when the output already exists."""
    df.write.mode("ignore").option("compression", "snappy").parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: str) -> bool:
    """Write one batch under ``batch_id=<id>``; a re-run replaces only that batch.
    Ids with path separators are rejected; an empty batch writes nothing."""
    if not _BATCH_ID.match(batch_id):
        raise ValueError(f"invalid batch id {batch_id!r}")
    if df.isEmpty():
        return False
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return True


def export_snapshot(df: DataFrame, path: str) -> None:
    """Export a mart snapshot with lower-case column names."""
    df.toDF(*[c.lower() for c in df.columns]).write.mode("overwrite").parquet(path)


def read_snapshot(spark, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.toDF(*[c.lower() for c in df.columns])


def write_metrics(df: DataFrame, path: str) -> None:
    """Persist metrics / threshold rows as JSON lines."""
    df.write.mode("overwrite").json(path)
