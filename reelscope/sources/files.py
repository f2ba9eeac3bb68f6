"""Folders of written tables, through the file system that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none where it does not exist."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table written to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")
