"""Typed staging views over bronze, and the rows they refuse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GRANTS, MBS_RENAMES, PREVIEW_RENAMES


def _uncastable(renames: dict[str, tuple[str, str]]) -> Column:
    """True where a value is present but does not read as its staged type."""
    checks = [
        F.col(source).isNotNull() & F.col(source).try_cast(kind).isNull()
        for source, kind in renames.values()
        if kind != "string"
    ]
    return reduce(lambda a, b: a | b, checks)


def _stage(bronze: DataFrame, renames: dict, required: tuple[str, ...], lenient: bool) -> DataFrame:
    present = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in required))
    rows = bronze.filter(present)
    if lenient:
        rows = rows.filter(~_uncastable(renames))
    return rows.select(
        *(F.col(source).cast(kind).alias(name) for name, (source, kind) in renames.items())
    )


def stage_preview(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    """Cast and rename flow records; rows without reporter or period are dropped.

    A value that does not cast fails the query (ANSI mode). ``lenient`` leaves such rows out
    instead; :func:`rejected_preview` returns them.
    """
    return _stage(bronze, PREVIEW_RENAMES, ("reportercode", "period"), lenient)


def stage_mbs(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    """Cast and rename bulletin records; rows without period are dropped."""
    return _stage(bronze, MBS_RENAMES, ("period",), lenient)


def rejected_preview(bronze: DataFrame) -> DataFrame:
    """Bronze rows that ``lenient`` staging leaves out."""
    return bronze.filter(
        F.col("reportercode").isNotNull() & F.col("period").isNotNull()
    ).filter(_uncastable(PREVIEW_RENAMES))


def valid_measures(staged: DataFrame) -> DataFrame:
    """Present and not negative. Spark orders NaN above every number, so it is named."""
    value = F.col("trade_value_usd")
    return staged.filter((value >= 0) & ~F.isnan(value))


def granted_view(silver: DataFrame, principal: str, table: str) -> DataFrame:
    """Only the columns ``principal`` may read; naming another one is an analysis error."""
    try:
        columns = GRANTS[principal][table]
    except KeyError:
        raise PermissionError(f"{principal} has no grant on {table}") from None
    return silver if columns is None else silver.select(*columns)
