"""Small files on the file system that Spark uses (any Hadoop URI): markers that name a finished state."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def locate(spark: SparkSession, path: str):
    """The Hadoop path, fully qualified, and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = locate(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = locate(spark, path)
    fs.mkdirs(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it isn't there."""
    p, fs = locate(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def read_marker(spark: SparkSession, path: str) -> str | None:
    """What a marker says; None where there is none."""
    p, fs = locate(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_marker(spark: SparkSession, path: str, text: str) -> bool:
    """A marker that appears whole; False where one was there first."""
    p, fs = locate(spark, path)
    own, _ = locate(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = fs.create(own, False)
    stream.writeUTF(text)
    stream.close()
    if fs.exists(p) or not fs.rename(own, p):
        fs.delete(own, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    """A marker or folder of this package's own making goes."""
    p, fs = locate(spark, path)
    fs.delete(p, True)
