"""Helpers shared by the operators: session, scratch tables, column rules."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# Separator classes fixed by the contracts of the queries.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITESPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to the Python workers; Arrow batches stay small however long the texts are."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, every
    later use sees the same rows, and lost executors cost nothing but a reread."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 4 << 20  # of a table that may be broadcast to a join


def broadcast_counted(df: DataFrame, row_bytes: int = 64, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a written table of narrow rows, broadcast if its counted rows fit into ``limit``; else joined by sorting."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column, separators: str) -> Column:
    """The maximal runs of other characters, in order (null text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def alnum_words(text: Column) -> Column:
    """Words of ASCII digits, letters (lower-cased) and all non-ASCII characters."""
    return split_words(ascii_lower(text), NOT_ALNUM)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator works on, so extra columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *[F.col(c) for c in more])
