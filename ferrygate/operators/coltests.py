"""Declared column tests on bronze, staging and silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCEPTED_VALUES, NON_NEGATIVE, NOT_NULL


class ColumnTestError(Exception):
    """Declared column tests failed."""


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Null is no failure."""
    return df.filter(~F.col(column).isin(*values))


def expression_failures(df: DataFrame, expression: Column) -> DataFrame:
    """Rows where the expression is false; null is no failure."""
    return df.filter(~expression)


def negative_values(staged: DataFrame) -> DataFrame:
    """Staged rows with a negative value."""
    return staged.filter(F.col("trade_value_usd") < 0).select(
        "reporter_code",
        "partner_code",
        "commodity_code",
        "flow_code",
        "period",
        "trade_value_usd",
    )


def declared_tests(table: str) -> list[tuple[str, str, Column]]:
    """``(test, column, failure condition)`` for a table."""
    tests = [("not_null", name, F.col(name).isNull()) for name in NOT_NULL.get(table, ())]
    tests += [
        ("accepted_values", name, ~F.col(name).isin(*values))
        for name, values in ACCEPTED_VALUES.get(table, {}).items()
    ]
    tests += [
        ("expression_is_true", name, ~(F.col(name) >= 0)) for name in NON_NEGATIVE.get(table, ())
    ]
    return tests


def run_column_tests(df: DataFrame, table: str, only: str | None = None) -> DataFrame:
    """All declared tests of a table in one pass: ``table_name, test, column_name, failures``."""
    tests = [t for t in declared_tests(table) if only in (None, t[0])]
    counted = df.agg(*(F.count_if(cond).alias(f"t{i}") for i, (_, _, cond) in enumerate(tests)))
    rows = F.array(
        *(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(test).alias("test"),
                F.lit(column).alias("column_name"),
                F.col(f"t{i}").alias("failures"),
            )
            for i, (test, column, _) in enumerate(tests)
        )
    )
    return counted.select(F.inline(rows))


def assert_column_tests(results: DataFrame) -> None:
    """Raise when any declared test has failures (one small row per declaration)."""
    bad = results.filter(F.col("failures") > 0).collect()
    if bad:
        raise ColumnTestError(
            "; ".join(
                f"{r['table_name']}.{r['column_name']} {r['test']}: {r['failures']} row(s)"
                for r in bad
            )
        )
