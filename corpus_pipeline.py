"""The corpus pipeline: five stages in order, each reading what its predecessor wrote.

Every stage keeps the columns of ``documents`` as they come, whatever else they hold, and names rows by file and row number, so
null or repeated ids and clashing column names do no harm. The last stage returns the mix instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrygate.llm.common import FILE_KEY, ROW_KEY, drop_rows, keep_rows, table, with_row_key
from ferrygate.llm.decontam import find_leaks
from ferrygate.llm.exact import exact_dedup
from ferrygate.llm.langid import fit, fold_of, rejects
from ferrygate.llm.mixing import mix
from ferrygate.llm.neardup import near_duplicates
from ferrygate.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts; without a letter, or below the calibrated threshold, they go."""
    model = fit(docs.select("doc_id", "text", "lang"), fold_of("doc_id", 4) != 2)
    return docs.filter(~rejects(model)(F.col("text")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space one row stays."""
    keyed = with_row_key(docs)
    kept = exact_dedup(keyed.select("doc_id", "text", FILE_KEY, ROW_KEY)).filter("kept")
    return keep_rows(keyed, kept, docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more) one row stays."""
    keyed = with_row_key(docs)
    gone = near_duplicates(keyed.select("doc_id", "text", FILE_KEY, ROW_KEY)).filter("not stays")
    return drop_rows(keyed, gone, docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    keyed = with_row_key(docs)
    leaks = find_leaks(keyed.select("doc_id", "text", FILE_KEY, ROW_KEY), table(spark, sf_dir, "benchmark"))
    return drop_rows(keyed, leaks, docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: what the mix takes of every document that is left."""
    return mix(docs.select("doc_id", "source", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


STAGES: list[tuple[str, Stage]] = [
    ("known_language", known_language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mix_sources", mix_sources),
]

#: Trained classifiers and signatures are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
