"""Existence test, partition removal and file sizes through the session's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _resolve(spark: SparkSession, path: str):
    handle = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _resolve(spark, path)
    return fs.exists(handle)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, in order."""
    handle, fs = _resolve(spark, pattern)
    found = fs.globStatus(handle)
    return sorted(str(status.getPath().toString()) for status in found) if found is not None else []


def remove_folder(spark: SparkSession, path: str) -> None:
    handle, fs = _resolve(spark, path)
    fs.delete(handle, True)


def file_sizes(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``(path, length)`` of the data files below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length")
    )
