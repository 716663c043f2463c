"""Named and served queries over the silver tables.

Every ranking names its null order and ends with the grain columns, so a limit always keeps the
same rows. Limits compile to a per-partition top-k; no global sort takes place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import growth_pct, scaled
from ..functions.text import (
    LIMIT_RANKING,
    LIMIT_SEARCH,
    LIMIT_SERIES,
    flow_argument,
    iso_argument,
    limit_argument,
    year_argument,
)

BILLION = 1e9
MILLION = 1e6


class NotFound(LookupError):
    """The query has no rows for its argument."""


def _desc(*names: str) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in names]


def _asc(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def annual(silver: DataFrame, **equal: str | None) -> DataFrame:
    """Annual rows, narrowed by each given ``column = value``."""
    rows = silver.filter(F.col("freq_code") == "A")
    for name, value in equal.items():
        if value is not None:
            rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def top_exporters(summary: DataFrame, period: str, unit: float = BILLION) -> DataFrame:
    """Twenty largest exporters of a period."""
    return (
        annual(summary, period=period)
        .orderBy(*_desc("export_value_usd"), *_asc("reporter_iso", "reporter_code"))
        .limit(20)
        .select(
            F.col("reporter_iso").alias("country_iso"),
            F.col("reporter_name").alias("country_name"),
            "period",
            scaled(F.col("export_value_usd"), unit, 2).alias("export_usd_bn"),
            scaled(F.col("import_value_usd"), unit, 2).alias("import_usd_bn"),
            scaled(F.col("trade_balance_usd"), unit, 2).alias("balance_usd_bn"),
            "commodity_count",
            "partner_count",
        )
    )


def top_commodities(
    flows: DataFrame, reporter_iso: str, period: str, unit: float = MILLION
) -> DataFrame:
    """Twenty largest flows of a reporter in a period."""
    return (
        annual(flows, reporter_iso=reporter_iso, period=period)
        .orderBy(
            *_desc("trade_value_usd"),
            *_asc("commodity_code", "flow_code", "partner_code", "type_code"),
        )
        .limit(20)
        .select(
            "commodity_code",
            "commodity_name",
            "flow_code",
            "flow_name",
            scaled(F.col("trade_value_usd"), unit, 2).alias("trade_value_usd_mn"),
            "source_record_count",
        )
    )


def bilateral_flows(
    flows: DataFrame,
    reporter_iso: str,
    partner_iso: str,
    commodity_code: str = "TOTAL",
    unit: float = BILLION,
) -> DataFrame:
    """Flows between two countries over all annual periods, one row per flow."""
    rows = annual(
        flows, reporter_iso=reporter_iso, partner_iso=partner_iso, commodity_code=commodity_code
    )
    return rows.orderBy(*_asc("period", "flow_code", "type_code")).select(
        "period",
        "reporter_iso",
        "partner_iso",
        "partner_name",
        "flow_code",
        "flow_name",
        scaled(F.col("trade_value_usd"), unit, 3).alias("trade_value_usd_bn"),
        "source_record_count",
    )


def yoy_growth(
    summary: DataFrame, base_period: str, period: str, unit: float = BILLION
) -> DataFrame:
    """Thirty fastest growing exporters between two periods."""
    base = annual(summary, period=base_period).select(
        "reporter_iso",
        "reporter_name",
        F.col("export_value_usd").alias("export_base"),
        F.col("import_value_usd").alias("import_base"),
    )
    current = annual(summary, period=period).select(
        "reporter_iso",
        F.col("export_value_usd").alias("export_curr"),
        F.col("import_value_usd").alias("import_curr"),
    )
    return (
        base.filter(F.col("export_base") > 0)
        .join(current, "reporter_iso")
        .select(
            "reporter_iso",
            "reporter_name",
            scaled(F.col("export_curr"), unit, 2).alias(f"export_{period}_usd_bn"),
            scaled(F.col("export_base"), unit, 2).alias(f"export_{base_period}_usd_bn"),
            growth_pct(F.col("export_curr"), F.col("export_base")).alias("export_growth_pct"),
            growth_pct(F.col("import_curr"), F.col("import_base")).alias("import_growth_pct"),
        )
        .orderBy(*_desc("export_growth_pct"), *_asc("reporter_iso"))
        .limit(30)
    )


def data_freshness(summary: DataFrame, unit: float = BILLION) -> DataFrame:
    """Newest annual period per reporter; the total is the largest over all its periods."""
    return (
        annual(summary)
        .groupBy("reporter_iso", "reporter_name")
        .agg(
            F.max("period").alias("latest_period"),
            F.count_distinct("period").alias("period_count"),
            scaled(F.max("total_trade_value_usd"), unit, 2).alias("latest_total_trade_usd_bn"),
        )
        .orderBy(
            *_desc("latest_period", "latest_total_trade_usd_bn"),
            *_asc("reporter_iso", "reporter_name"),
        )
        .limit(50)
    )


_MEASURES = (
    "export_value_usd", "import_value_usd", "total_trade_value_usd", "trade_balance_usd",
    "commodity_count", "partner_count",
)


def list_reporters(
    summary: DataFrame, period: str | None = None, limit: int | None = None
) -> DataFrame:
    """Reporters ranked by total trade."""
    wanted = year_argument(period) if period else None
    return (
        annual(summary, period=wanted)
        .orderBy(*_desc("total_trade_value_usd"), *_asc("period", "reporter_iso", "reporter_code"))
        .limit(limit_argument(limit, LIMIT_RANKING))
        .select("reporter_iso", "reporter_name", "period", *_MEASURES)
    )


def reporter_series(
    summary: DataFrame, reporter_iso: str, limit: int | None = None, must_exist: bool = False
) -> DataFrame:
    """Annual series of one reporter, newest first.

    ``must_exist`` runs the query once to raise :class:`NotFound` for a reporter without rows.
    """
    iso = iso_argument(reporter_iso)
    rows = (
        annual(summary, reporter_iso=iso)
        .orderBy(*_desc("period"), *_asc("reporter_code"))
        .limit(limit_argument(limit, LIMIT_SERIES))
        .select("period", *_MEASURES)
    )
    if must_exist and rows.isEmpty():
        raise NotFound(f"no rows for reporter {iso}")
    return rows


def search_flows(
    flows: DataFrame,
    reporter_iso: str | None = None,
    partner_iso: str | None = None,
    period: str | None = None,
    flow_code: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Largest annual flows under any combination of four filters."""
    rows = annual(
        flows,
        reporter_iso=iso_argument(reporter_iso) if reporter_iso else None,
        partner_iso=iso_argument(partner_iso) if partner_iso else None,
        period=year_argument(period) if period else None,
        flow_code=flow_argument(flow_code) if flow_code else None,
    )
    return (
        rows.orderBy(
            *_desc("trade_value_usd"),
            *_asc(
                "period", "reporter_code", "partner_code", "commodity_code", "flow_code",
                "type_code",
            ),
        )
        .limit(limit_argument(limit, LIMIT_SEARCH))
        .select(
            "period",
            "reporter_iso",
            "reporter_name",
            "partner_iso",
            "partner_name",
            "commodity_code",
            "commodity_name",
            "flow_code",
            "flow_name",
            "trade_value_usd",
        )
    )
