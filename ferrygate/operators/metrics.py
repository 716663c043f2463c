"""Metric points, their daily panels, and the scan alarm (M1, M3-M7, A5).

Metric points: ``ts, metric, unit, value, dims`` with ``dims`` a map of text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from .quality import RUN, judged_by

# Metric names, units, panel statistics, bytes per gigabyte.
SUM_METRICS = (
    "RowCount", "ChecksPassed", "ChecksFailed", "JsonBytesWritten", "DbtModelsErrored",
    "DbtTestsFailed",
)
DURATION_METRIC = "DbtRunDuration"
BYTES_PER_GB = 1073741824
ALARM_WINDOW = "5 minutes"


def dims_label(dims: Column) -> Column:
    """Dimension map as ordered ``name=value`` text, usable as a grouping key."""
    entries = F.array_sort(F.map_entries(dims))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")


def validation_metrics(results: DataFrame) -> DataFrame:
    """Metric rows per run from check results; bytes only where the file size is known."""
    by = judged_by(results)
    size = F.col("file_size").cast("double") if "file_size" in by else F.lit(None).cast("double")
    rows = F.when(F.col("name") == "check_row_count", F.col("details")["row_count"].cast("double"))
    counts = (
        results.groupBy(*by)
        .agg(
            F.coalesce(F.max(rows), F.lit(0.0)).alias("RowCount"),
            F.count_if("passed").cast("double").alias("ChecksPassed"),
            F.count_if(~F.col("passed")).cast("double").alias("ChecksFailed"),
        )
        .withColumn("JsonBytesWritten", size)
    )
    names = ["RowCount", "ChecksPassed", "ChecksFailed", "JsonBytesWritten"]
    unit = F.when(F.col("metric") == "JsonBytesWritten", "Bytes").otherwise("Count")
    return (
        counts.unpivot(list(RUN), names, "metric", "value")
        .filter(F.col("value").isNotNull())
        .select(*RUN, "metric", unit.alias("unit"), "value")
    )


def metric_points(metrics: DataFrame, dag_id: Column, ts: Column) -> DataFrame:
    """Metric rows as points with job and endpoint dimensions."""
    dims = F.create_map(F.lit("DagId"), dag_id, F.lit("Endpoint"), F.col("endpoint"))
    return metrics.select(ts.alias("ts"), "metric", "unit", "value", dims.alias("dims"))


def node_status(line: Column) -> Column:
    """Status of a run-log line; null for lines that are not JSON."""
    # Parsed inside a list, so trailing text after the object makes the line malformed.
    wrapped = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.try_variant_get(wrapped, "$[0].data.node_info.node_status", "string")


def runlog_status(lines: DataFrame, line: str = "value", by: tuple[str, ...] = ()) -> DataFrame:
    """Errored models and failed tests in a JSON-lines run log."""
    status = node_status(F.col(line))
    return lines.groupBy(*by).agg(
        F.count_if(status == "error").alias("models_errored"),
        F.count_if(status == "fail").alias("tests_failed"),
    )


def _by_day(points: DataFrame, *keys: str):
    rows = points.withColumn("dims", dims_label(F.col("dims")))
    return rows.groupBy(F.window("ts", "1 day").alias("w"), *keys)


def _day() -> Column:
    return F.col("w.start").cast("date").alias("day")


def daily_sums(points: DataFrame, metrics: tuple[str, ...] = SUM_METRICS) -> DataFrame:
    """Sum per metric, dimension set and day."""
    return (
        _by_day(points.filter(F.col("metric").isin(*metrics)), "metric", "dims")
        .agg(exact_sum(F.col("value")).alias("total"))
        .select(_day(), "metric", "dims", "total")
    )


def daily_average(points: DataFrame, metric: str = DURATION_METRIC) -> DataFrame:
    """Average per dimension set and day (phase durations)."""
    return (
        _by_day(points.filter(F.col("metric") == metric), "metric", "dims")
        .agg(
            (exact_sum(F.col("value")) / F.count("value")).alias("average"),
        )
        .select(_day(), "metric", "dims", "average")
    )


def failure_rate(points: DataFrame) -> DataFrame:
    """Failed checks in percent of all checks per dimension set and day; null without checks."""
    checks = points.filter(F.col("metric").isin("ChecksPassed", "ChecksFailed"))
    failed = exact_sum(
        F.when(F.col("metric") == "ChecksFailed", F.col("value")).otherwise(F.lit(0.0))
    )
    return (
        _by_day(checks, "dims")
        .agg(
            failed.alias("failed"),
            exact_sum(F.col("value")).alias("checks"),
        )
        .select(
            _day(),
            "dims",
            (F.col("failed") / F.nullif(F.col("checks"), F.lit(0.0)) * 100).alias("failure_rate_pct"),
        )
    )


def alarm_sums(points: DataFrame, metric: str | None, window: str = ALARM_WINDOW) -> DataFrame:
    """Sum per tumbling window; works on a batch and on a stream with a watermark."""
    rows = points if metric is None else points.filter(F.col("metric") == metric)
    return rows.groupBy(F.window("ts", window).alias("w")).agg(
        exact_sum(F.col("value")).alias("total")
    )


def scan_alarm(
    points: DataFrame, threshold: float, metric: str | None = None, window: str = ALARM_WINDOW
) -> DataFrame:
    """Windows whose sum is strictly above the threshold. Windows without points do not fire."""
    return (
        alarm_sums(points, metric, window)
        .filter(F.col("total") > threshold)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total")
    )
