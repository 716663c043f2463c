"""BI extract datasets (S7): annual rows, money as decimals, counts as integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import REPORTER_SUMMARY, TRADE_FLOWS

_EXTRACT_TYPES = {"double": "decimal(28,2)", "bigint": "int", "int": "int", "string": "string"}


def _extract(silver: DataFrame, schema) -> DataFrame:
    return silver.filter(F.col("freq_code") == "A").select(
        *(
            F.col(field.name).cast(_EXTRACT_TYPES[field.dataType.simpleString()]).alias(field.name)
            for field in schema.fields
        )
    )


def bi_reporter_summary(summary: DataFrame) -> DataFrame:
    return _extract(summary, REPORTER_SUMMARY)


def bi_trade_flows(flows: DataFrame) -> DataFrame:
    return _extract(flows, TRADE_FLOWS)


def refresh_extract(extract: DataFrame, path: str) -> None:
    """Full refresh."""
    extract.write.mode("overwrite").parquet(path)
