"""Shared helpers of the corpus operators: tables, row keys, word expressions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: The characters that separate words everywhere in this subpackage.
SPACE = r"\x20\x09-\x0D"
FILE_KEY, ROW_KEY = "__file_key", "__row_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with two long columns that name a row for good: its file's hash and its row number there.

    The key does not depend on how a scan is split, so two jobs over the same files agree on it even
    if executors come and go between them. A frame that is not a plain file scan is written to the
    shared scratch folder first. A frame that has keys already keeps them.
    """
    if {FILE_KEY, ROW_KEY} <= set(docs.columns):
        return docs
    try:
        return _keyed(docs)
    except AnalysisException:
        spark = docs.sparkSession
        path = scratch_dir(spark, "keyed")
        docs.write.parquet(path)
        return _keyed(spark.read.schema(docs.schema).parquet(path))


def _keyed(docs: DataFrame) -> DataFrame:
    keyed = docs.select(
        "*",
        F.xxhash64(F.col("_metadata.file_path")).alias(FILE_KEY),
        F.col("_metadata.row_index").alias(ROW_KEY),
    )
    keyed.schema  # resolves the names now
    return keyed


def keep_rows(keyed: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``keyed`` whose key is in ``kept``, with ``columns`` only."""
    return keyed.join(kept.select(FILE_KEY, ROW_KEY), [FILE_KEY, ROW_KEY], "left_semi").select(*map(_quoted, columns))


def drop_rows(keyed: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    return keyed.join(dropped.select(FILE_KEY, ROW_KEY), [FILE_KEY, ROW_KEY], "left_anti").select(*map(_quoted, columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
