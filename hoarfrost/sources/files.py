"""Folder listing through Spark's own file system layer, so any supported store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int, int]]:
    """Name, is-folder, modification time in ms and length of each entry of a folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(
        (s.getPath().getName(), s.isDirectory(), s.getModificationTime(), s.getLen()) for s in fs.listStatus(p)
    )


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def total(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below a path."""
    fs, p = _fs(spark, path)
    summary = fs.getContentSummary(p)
    return summary.getFileCount(), summary.getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
