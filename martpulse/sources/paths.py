"""Existence, listing and deletion of paths on any file system that Spark reads (through Hadoop's API)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    at, fs = _at(spark, pattern)
    return [str(s.getPath()) for s in fs.globStatus(at) or []]


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    at, fs = _at(spark, path)
    return fs.getContentSummary(at).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small ASCII file, replaced if it is there."""
    at, fs = _at(spark, path)
    out = fs.create(at, True)
    try:
        out.writeBytes(text)
    finally:
        out.close()
