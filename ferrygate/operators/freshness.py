"""Source freshness from the load stamp."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Age limits in days.
WARN_AFTER_DAYS = 26
ERROR_AFTER_DAYS = 35
_DAY = 86400


class StaleSource(Exception):
    """A source is older than the error limit."""


def freshness_status(age_seconds: Column) -> Column:
    """``pass``, ``warn`` or ``error``; a source never loaded is an error."""
    return (
        F.when(age_seconds.isNull() | (age_seconds > ERROR_AFTER_DAYS * _DAY), "error")
        .when(age_seconds > WARN_AFTER_DAYS * _DAY, "warn")
        .otherwise("pass")
    )


def source_freshness(bronze: DataFrame, table: str, now: str) -> DataFrame:
    """One row: newest stamp, age in seconds at ``now`` (ISO-8601 text), status."""
    newest = bronze.agg(F.max(F.to_timestamp("_loaded_at")).alias("max_loaded_at"))
    age = F.unix_timestamp(F.to_timestamp(F.lit(now))) - F.unix_timestamp("max_loaded_at")
    return newest.select(
        F.lit(table).alias("table_name"),
        "max_loaded_at",
        age.alias("age_seconds"),
        freshness_status(age).alias("status"),
    )


def freshness_report(tables: dict[str, DataFrame], now: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName, (source_freshness(df, name, now) for name, df in tables.items())
    )


def assert_fresh(report: DataFrame) -> None:
    """Stop on any source in error (one row per source)."""
    stale = [row["table_name"] for row in report.filter(F.col("status") == "error").collect()]
    if stale:
        raise StaleSource(f"stale sources: {', '.join(sorted(stale))}")
