"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .filesystem import remove_folder

_local_scratch: list[str] = []


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName("ferrygate")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """New folder name below ``spark.checkpoint.dir``.

    Executors on other machines must see it, so the cluster's own setting wins.
    Only where none is set (single-machine tests) a local folder is made, which
    is removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="ferrygate-"))
            atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
        shared = _local_scratch[0]
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def open_writers(spark: SparkSession, files: int = 8):
    """Writes to partition folders keep so many files open per task, and sort its rows only where it meets more folders.

    What a task holds is then the row groups of its files, which are encoded, instead of all its rows.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, label: str, rows_per_group: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several actions need the same result: it cuts the lineage, outlives
    lost executors, and stays columnar so later reads prune and push down. Who made a copy
    for itself hands it to :func:`release` when it is done. A reader holds thousands of rows at once unless a
    row group has fewer: ``rows_per_group`` is for rows of long texts.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    writer = df.write.mode("error")
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    writer.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy._scratch_path = path
    return copy


def release(*copies: DataFrame) -> None:
    """Remove materialised copies that nothing reads any more."""
    for copy in copies:
        if path := getattr(copy, "_scratch_path", None):
            remove_folder(copy.sparkSession, path)
