"""Typed scans of the raw layer and freshness of its tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hadoop

NAMELESS = "__HIVE_DEFAULT_PARTITION__"


def scan_raw(spark: SparkSession, path: str, schema: T.StructType, base_path: str | None = None,
             skip_corrupt: bool = False) -> DataFrame:
    """Scan a Hive-partitioned Parquet prefix with an explicit contract schema.

    Columns bind by name (case-insensitive by default), a missing column
    reads as null, extra file columns are ignored; partition columns come
    from the directory names below ``base_path``. An unreadable file fails the
    load, unless ``skip_corrupt``; ``skipped_files`` then tells which ones.
    """
    return (spark.read.schema(schema).option("basePath", base_path or path)
            .option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(path))


def skipped_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files under ``path`` that a ``skip_corrupt`` scan gives no row of: unreadable or empty ones."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", "true").load(path).select("path")
    seen = scan_raw(spark, path, schema, skip_corrupt=True).select(F.col("_metadata.file_path").alias("path")).distinct()
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    return there.withColumn("path", plain("path")).join(seen.withColumn("path", plain("path")), "path", "left_anti")


def _write_texts(folder: str):
    """mapInArrow body: (name, text) rows become files in a folder of the task, which appears when complete; a
    repeated task finds it there or makes it anew."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if folder.startswith("file:"):
            fs, top = pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
        else:
            fs, top = pafs.FileSystem.from_uri(folder)
        own, done, n = f"{top}/_{uuid.uuid4().hex}", f"{top}/part-{TaskContext.get().partitionId():05d}", 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n == 0:
                    fs.create_dir(own)
                with fs.open_output_stream(f"{own}/{n}={quote(name, safe='')}.txt", compression=None) as out:
                    out.write((text or "").encode() + b"\n")
                n += 1
        if n:
            try:
                fs.move(own, done)
            except OSError:
                if fs.get_file_info(done).type != pafs.FileType.Directory:
                    raise
                fs.delete_dir(own)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def write_whole_files(df: DataFrame, folder: str, name: str, text: str) -> None:
    """One file per row below ``folder``, written by the tasks themselves (a file system that pyarrow knows by its URI): no
    folder, check sum or rename per file, so millions are no matter. Rows of one name are files of their own."""
    hadoop.make_folder(df.sparkSession, folder)
    uri = hadoop.locate(df.sparkSession, folder)[0].toString()
    df.select(F.coalesce(name, F.lit(NAMELESS)).alias("name"), F.col(text).alias("text")) \
        .mapInArrow(_write_texts(uri), "n bigint").write.format("noop").mode("overwrite").save()


def file_name(path: str | Column) -> Column:
    """The name that ``write_whole_files`` got for a file."""
    return F.url_decode(F.regexp_extract(path, r"/[0-9]+=([^/]*)\.txt$", 1))


def whole_files(spark: SparkSession, path: str, glob: str = "*", text: str = "doc") -> DataFrame:
    """One row per file below ``path``: its ``file_path`` and all its text. (Spark's readers
    pass over files of no bytes, so these have no row.)"""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file_path"), F.decode("content", "UTF-8").alias(text))


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and newest file time of each table (file metadata column of the scan)."""
    parts = []
    for name, df in tables.items():
        parts.append(df.select(F.col("_metadata.file_modification_time").alias("t")).agg(
            F.count(F.lit(1)).alias("row_count"), F.max("t").alias("loaded_at"))
            .select(F.lit(name).alias("product"), "row_count", "loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
