"""Training rows of the two classifiers: a bounded, documented sample of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_rows


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out: int,
                  max_rows: int) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` documents outside the held-out
    fold, the ones whose ids hash lowest. Repeated labels of an id: the larger
    one counts; repeated rows of an id: one text counts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = text_rows(docs).join(F.broadcast(chosen), "doc_id")  # max_rows ids and labels
    return rows.groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
