"""Silver aggregates and the incremental guard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import PARTS, sum_parts, total
from ..schemas import REPORTER_SUMMARY, TRADE_FLOWS
from .staging import valid_measures

FLOW_DIMENSIONS = tuple(TRADE_FLOWS.names[:13])
REPORTER_DIMENSIONS = tuple(REPORTER_SUMMARY.names[:5])

EARLIEST = "0000"


def flows_exact(staged: DataFrame) -> DataFrame:
    """Flows at their natural grain; the value stays in the exact parts ``PARTS``."""
    parts = sum_parts(F.col("trade_value_usd"))
    return (
        valid_measures(staged)
        .groupBy(*FLOW_DIMENSIONS)
        .agg(
            *(F.sum(part).alias(name) for part, name in zip(parts, PARTS)),
            F.count("*").alias("source_record_count"),
        )
    )


def as_trade_flows(exact: DataFrame) -> DataFrame:
    value = total(*map(F.col, PARTS))
    return exact.select(*FLOW_DIMENSIONS, value.alias("trade_value_usd"), "source_record_count")


def trade_flows(staged: DataFrame) -> DataFrame:
    return as_trade_flows(flows_exact(staged))


def _sums_of(parts: tuple[Column, ...], name: str, flow: str | None = None) -> list[Column]:
    """Sums of the parts over all flows or over one."""
    if flow is not None:
        parts = tuple(F.when(F.col("flow_code") == flow, part) for part in parts)
    return [F.sum(part).alias(f"{name}{part_name}") for part, part_name in zip(parts, PARTS)]


def _summarise(rows: DataFrame, parts: tuple[Column, ...]) -> DataFrame:
    def summed(name: str) -> list[Column]:
        return [F.col(f"{name}{part}") for part in PARTS]

    zero = F.lit(0)
    balance = total(*(F.coalesce(x, zero) - F.coalesce(m, zero) for x, m in zip(summed("x"), summed("m"))))
    return (
        rows.groupBy(*REPORTER_DIMENSIONS)
        .agg(
            *_sums_of(parts, "x", "X"),
            *_sums_of(parts, "m", "M"),
            *_sums_of(parts, "t"),
            # Distinct values are reduced on the map side, so a reporter with very many rows
            # sends only its distinct commodities and partners over the network.
            F.count_distinct("commodity_code").alias("commodity_count"),
            F.count_distinct("partner_code").alias("partner_count"),
        )
        .select(
            *REPORTER_DIMENSIONS,
            F.coalesce(total(*summed("x")), F.lit(0.0)).alias("export_value_usd"),
            F.coalesce(total(*summed("m")), F.lit(0.0)).alias("import_value_usd"),
            total(*summed("t")).alias("total_trade_value_usd"),
            balance.alias("trade_balance_usd"),
            "commodity_count",
            "partner_count",
        )
    )


def reporter_summary(staged: DataFrame) -> DataFrame:
    """Totals per reporter and period; the total covers every flow, re-exports included."""
    # Two distinct counts make Spark triple what they read: rows are added up first where nothing the summary tells apart differs.
    grain = (*REPORTER_DIMENSIONS, "flow_code", "commodity_code", "partner_code")
    parts = sum_parts(F.col("trade_value_usd"))
    rows = valid_measures(staged).groupBy(*grain).agg(*(F.sum(part).alias(name) for part, name in zip(parts, PARTS)))
    return summary_from_flows(rows)


def summary_from_flows(exact: DataFrame) -> DataFrame:
    """The same summary from :func:`flows_exact`, whose grain is finer: no second bronze scan."""
    return _summarise(exact, tuple(map(F.col, PARTS)))


def guard_of(target: DataFrame | None, mode: str = "per_freq") -> dict[str | None, str]:
    """Newest loaded period, per frequency or (``reference`` mode) over all rows.

    Periods compare as text, so one monthly load would hide all annual rows from a common
    guard; hence the default per frequency. The result is one entry per frequency code.
    """
    if mode not in ("per_freq", "reference"):
        raise ValueError(f"unknown guard mode {mode!r}")
    if target is None:
        return {}
    if mode == "reference":
        newest = target.agg(F.max("period")).first()[0]
        return {} if newest is None else {None: newest}
    rows = target.groupBy("freq_code").agg(F.max("period").alias("p")).collect()
    return {row["freq_code"]: row["p"] for row in rows}


def incremental(staged: DataFrame, guard: dict[str | None, str], mode: str) -> DataFrame:
    """Rows at or after the guard. The guard is a literal, so bronze folders are pruned."""
    if not guard:
        return staged.filter(F.col("period") >= EARLIEST)
    if mode == "reference":
        return staged.filter(F.col("period") >= guard[None])
    freq = F.col("freq_code")
    known = [
        freq.eqNullSafe(F.lit(code)) & (F.col("period") >= newest) for code, newest in guard.items()
    ]
    codes = [code for code in guard if code is not None]
    unseen = ~freq.isin(*codes) if codes else freq.isNotNull()
    if None not in guard:
        unseen = unseen | freq.isNull()
    return staged.filter(reduce(lambda a, b: a | b, known) | unseen)
