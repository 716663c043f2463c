"""Personal-data scan of what is new: a ledger of the files that were scanned.

A file is known by its path, length and modification time, a scan by the version of the detectors. The monthly scan
lists the folder, leaves out what the ledger has, and reads the rest in batches of ``FILES_PER_BATCH`` files, so a scan that is cut
short loses one batch. A batch writes its findings first and then its files: findings without their files are no part of the
ledger, and the batch is repeated. Reports join the findings back to the files that stand in the folder now, so those of a file
that was replaced or removed are gone from them without a scan.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..filesystem import exists
from .governance import DETECTORS, FINDING, pii_findings

FILES_PER_BATCH = 10_000
FILE = ("uri", "length", "modified")
SEEN = "table_name string, uri string, length long, modified timestamp, detectors int, batch string"
FOUND = f"{FINDING}, uri string, batch string"


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``(path, uri, length, modified)`` of the data files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _seen(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """One batch per file that these detectors scanned, also where two scans met."""
    rows = _table(spark, f"{ledger}/files", SEEN).filter((F.col("table_name") == table) & (F.col("detectors") == DETECTORS))
    return rows.groupBy(*FILE).agg(F.max("batch").alias("batch"))


def _pattern_safe(path: str) -> str:
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def _batches(files: DataFrame) -> Iterator[list]:
    """Rows of ``files`` in the order of their names, a batch at a time."""
    rows = files.orderBy("uri").toLocalIterator()
    while batch := list(islice(rows, FILES_PER_BATCH)):
        yield batch


def scan_new(
    spark: SparkSession,
    folder: str,
    ledger: str,
    table: str,
    key: str,
    schema: StructType | str,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    glob: str = "*.parquet",
) -> int:
    """Scan the files of ``folder`` that the ledger lacks; returns how many were read."""
    unseen = listing(spark, folder, glob).join(_seen(spark, ledger, table).drop("batch"), [*FILE], "left_anti")
    read = 0
    for batch in _batches(unseen):
        name = uuid.uuid4().hex
        paths = [_pattern_safe(row["path"]) for row in batch]
        rows = spark.read.format(fmt).schema(schema).option("basePath", folder).load(paths)
        rows = rows.withColumn("__uri", F.col("_metadata.file_path"))
        found = pii_findings(rows, table, key, columns or _text_columns(rows, key), keep={"uri": "__uri"})
        found.withColumn("batch", F.lit(name)).write.mode("append").parquet(f"{ledger}/findings")
        _remember(spark, ledger, [(table, *(row[c] for c in FILE), DETECTORS, name) for row in batch])
        read += len(batch)
    return read


def _remember(spark: SparkSession, ledger: str, files: list[tuple]) -> None:
    spark.createDataFrame(files, SEEN).coalesce(1).write.mode("append").parquet(f"{ledger}/files")


def _text_columns(rows: DataFrame, key: str) -> list[str]:
    return [name for name, kind in rows.dtypes if kind == "string" and name not in (key, "__uri")]


def known_findings(spark: SparkSession, folder: str, ledger: str, table: str, glob: str = "*.parquet") -> DataFrame:
    """Findings in the files that stand in ``folder`` now, as the ledger has them; the files themselves are not read."""
    current = listing(spark, folder, glob).drop("path").join(_seen(spark, ledger, table), [*FILE])
    found = _table(spark, f"{ledger}/findings", FOUND).filter(F.col("table_name") == table)
    return found.join(current.select("uri", "batch"), ["uri", "batch"], "left_semi").drop("batch")
