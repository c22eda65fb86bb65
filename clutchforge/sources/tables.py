"""Access to the input tables of one data directory.

Every reader is lazy: Catalyst prunes columns and pushes filters into the
Parquet scan, so callers just select what they need.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from . import hadoop

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

MATCH_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


class Catalog:
    """Input tables under ``root`` plus a memo for derived DataFrames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._memo: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(f"unknown table {name!r}")
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def memo(self, key: str, build) -> DataFrame:
        """Build a derived DataFrame once per catalog (same plan object, so
        Spark can reuse shared exchanges inside one query)."""
        if key not in self._memo:
            self._memo[key] = build(self)
        return self._memo[key]

    @cached_property
    def shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    # ------------------------------------------------------------------ raw layer
    @cached_property
    def _input(self) -> list[tuple[str, int, int]]:
        root, fs = hadoop.locate(self.spark, self.root)
        out, todo = [], [root]
        while todo:
            for f in fs.listStatus(todo.pop()):
                if f.isDirectory():
                    todo.append(f.getPath())
                else:
                    out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return out

    def input_files(self) -> list[str]:
        """``path length modification-time`` of every input file of the directory."""
        return sorted(f"{path} {length} {time}" for path, length, time in self._input)

    def input_bytes(self) -> int:
        """The size of the files of the tables that the match-domain tables are derived from."""
        return sum(length for path, length, _ in self._input if any(f"/{t}.parquet" in path for t in MATCH_TABLES))

    @cached_property
    def raw_store(self) -> str:
        """Folder of the tables derived from this input directory.

        Lives under the shared checkpoint folder (spark.checkpoint.dir), keyed by the input
        files (paths, lengths, modification times) and the package code, so
        changed input or a changed rule never reads tables made before.
        """
        from ..session import ensure_checkpoint_dir
        base, master = os.environ.get("CLUTCHFORGE_RAW_DIR"), self.spark.sparkContext.master
        if base and master != "local" and not master.startswith("local["):
            raise RuntimeError("CLUTCHFORGE_RAW_DIR is for local runs; on a cluster spark.checkpoint.dir names the shared folder")
        base = base or ensure_checkpoint_dir(self.spark).rstrip("/")
        pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        h = hashlib.md5("\n".join(self.input_files()).encode())
        for dirpath, dirs, files in sorted(os.walk(pkg)):
            if "llm" in dirpath[len(pkg):].split(os.sep):
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(dirpath, f), "rb") as fh:
                        h.update(fh.read())
        return f"{base}/clutchforge_raw/{h.hexdigest()[:16]}"

    def _published(self, name: str) -> str | None:
        """The folder of a finished table: its marker names it."""
        return hadoop.read_marker(self.spark, f"{self.raw_store}/{name}.published")

    def _publish(self, name: str, path: str) -> str:
        """Name ``path`` as the table, unless another job was first; the table's folder."""
        hadoop.write_marker(self.spark, f"{self.raw_store}/{name}.published", path)
        return self._published(name)

    def stored(self, name: str, write) -> str:
        """The folder of derived data; ``write(folder)`` fills one of its own when it is not there yet."""
        path = self._published(name)
        if path is None:
            path = f"{self.raw_store}/{name}/{uuid.uuid4().hex}"
            write(path)
            path = self._publish(name, path)
        return path

    def raw_path(self, name: str, build, partition_by: tuple[str, ...] = ()) -> str:
        """The folder of a derived table, Parquet partitioned by ``partition_by``."""
        def write(path: str) -> None:
            w = build(self).write.option("compression", "snappy")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return self.stored(name, write)

    def raw(self, name: str, build, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """A raw table: derived once with ``build(self)`` and written as Parquet
        (partitioned by ``partition_by``), then read like ingested raw files."""
        key = f"raw:{name}"
        if key not in self._memo:
            self._memo[key] = self.spark.read.parquet(self.raw_path(name, build, partition_by))
        return self._memo[key]
