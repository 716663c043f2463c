"""Every registered query, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coltests, drift, freshness, governance, maintenance, metrics, quality
from ..operators.lineage import lineage_edges
from ..operators.silver import (
    as_trade_flows,
    flows_exact,
    guard_of,
    incremental,
    reporter_summary,
    summary_from_flows,
    trade_flows,
)
from ..operators.staging import granted_view, rejected_preview, stage_mbs, stage_preview
from ..operators.upsert import read_silver, upsert
from ..plans import loads, queries as q
from ..schemas import (
    ENDPOINTS,
    REPORTER_SUMMARY,
    REPORTER_SUMMARY_KEY,
    TRADE_FLOWS,
    TRADE_FLOWS_KEY,
)
from ..session import materialize, scratch_dir
from ..sources import bronze, deadletter, extracts
from ..sources.envelopes import filter_endpoint
from . import tables as t

# Arguments of the parametrised queries; the oracles use the same.
REPORTER, PARTNER, COMMODITY = "NC", "NF", "PROMO"
BASE_YEAR, YEAR = "1996", "1997"
UNIT = 1e3
SPLIT_YEAR = 1999
LOADED_AT = "2002-01-01T00:00:00+00:00"
FRESH_NOW = "2001-08-30T00:00:00+00:00"
RETENTION_NOW = "2024-04-14T12:00:00+00:00"
DRIFT_DAY = "2024-01-16"
ALARM_LIMIT = 20.0
ALARM_METRIC = "JsonBytesWritten"
BACKFILL_PERIODS = ["1996", "1997", "199901", "2099"]

Query = Callable[[SparkSession, str], DataFrame]


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_preview(t.bronze_preview(spark, sf_dir))


def lenient_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_preview(t.dirty_preview(spark, sf_dir), lenient=True)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_flows(staged(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporter_summary(staged(spark, sf_dir))


def _on_summary(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(summary(spark, sf_dir))


def _on_flows(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(flows(spark, sf_dir))


def _flat(results: DataFrame) -> DataFrame:
    """Check results with their details as ordered text."""
    return results.withColumn("details", metrics.dims_label(F.col("details")))


def check_options() -> quality.CheckOptions:
    return quality.CheckOptions.of(ENDPOINTS[t.ENDPOINT], freq=F.col("freqcode"))


def _check(name: str, **only) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        options = quality.CheckOptions(**{**only, "freq": F.col("freqcode") if "freq" in only else None})
        return _flat(quality.one_check(t.dirty_preview(spark, sf_dir), name, options))

    return run


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite over the dirty records, of which it needs a few columns and two passes."""
    options = check_options()
    rows = t.dirty_preview(spark, sf_dir).select(*quality.RUN, "freqcode", *options.columns())
    return quality.run_suite(materialize(rows, "records"), options)


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(suite_results(spark, sf_dir))


def validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.validation_metrics(suite_results(spark, sf_dir))


def gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed_runs(suite_results(spark, sf_dir))


def column_tests(test: str) -> Query:
    """One kind of declared test over bronze, staging and silver of the dirty rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Four tables are built from the same records: they are joined together once.
        dirty = materialize(t.dirty_preview(spark, sf_dir), "dirty")
        rows = stage_preview(dirty, lenient=True)
        exact = flows_exact(rows)
        frames = {
            "preview": dirty,
            "previewtariffline": dirty,
            "getmbs": dirty,
            "stg_preview": rows,
            "stg_mbs": stage_mbs(t.as_series(dirty), lenient=True),
            "trade_flows": as_trade_flows(exact),
            "reporter_summary": summary_from_flows(exact),
        }
        parts = [
            coltests.run_column_tests(df, name, only=test)
            for name, df in frames.items()
            if any(kind == test for kind, _, _ in coltests.declared_tests(name))
        ]
        return reduce(DataFrame.unionByName, parts)

    return run


def negative_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coltests.negative_values(lenient_staged(spark, sf_dir))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_preview(t.dirty_preview(spark, sf_dir)).select(
        "run_id", "l_orderkey", "reportercode", "partnercode", "period", "freqcode"
    )


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {"preview": t.bronze_preview(spark, sf_dir), "getmbs": t.bronze_mbs(spark, sf_dir)}
    newest = F.to_utc_timestamp("max_loaded_at", F.current_timezone())
    return freshness.freshness_report(sources, FRESH_NOW).withColumn(
        "max_loaded_at", F.date_format(newest, t.ISO_FORMAT)
    )


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.user_key_records(spark, sf_dir)
    before, after = (
        materialize(drift.observed_json_keys(records.filter(part), "record"), "columns")
        for part in (F.col("day") < DRIFT_DAY, F.col("day") >= DRIFT_DAY)
    )
    return drift.drift(after, before)


def _older(rows: DataFrame) -> DataFrame:
    return rows.filter(F.substring("period", 1, 4) <= str(SPLIT_YEAR))


def _newer(rows: DataFrame) -> DataFrame:
    """Rows from the split year on, with doubled values."""
    newer = rows.filter(F.substring("period", 1, 4) >= str(SPLIT_YEAR))
    return newer.withColumn("trade_value_usd", F.col("trade_value_usd") * 2)


def guarded(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialize(staged(spark, sf_dir).select("freq_code", "period"), "staged")
        passed = incremental(rows, guard_of(_older(rows), mode), mode)
        return passed.groupBy("freq_code", "period").agg(F.count("*").alias("n_rows"))

    return run


def _upsert(aggregate, keys, schema, label: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialize(staged(spark, sf_dir), "staged")
        path = scratch_dir(spark, label)
        upsert(materialize(aggregate(_older(rows)), label), path, keys, schema)
        upsert(materialize(aggregate(_newer(rows)), label), path, keys, schema)
        return read_silver(spark, path, schema)

    return run


def backfill_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.bronze_preview(spark, sf_dir)
    spoiled = (F.col("period") == YEAR) & (F.col("l_orderkey") % 97 == 0)
    code = F.when(~spoiled, F.col("reportercode"))
    records = t.landed_fields(rows.withColumn("reportercode", code))
    conf = {"endpoint": t.ENDPOINT, "periods": BACKFILL_PERIODS, "freq_code": None}
    return loads.backfill(records, conf, scratch_dir(spark, "bronze"), LOADED_AT, strict=False)


def silver_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with a build after each; the second one is incremental."""
    work = scratch_dir(spark, "build")
    rows = materialize(t.landed_fields(t.bronze_preview(spark, sf_dir)), "landed")
    first = F.substring("period", 1, 4) < str(SPLIT_YEAR)
    for load, part in (("a", rows.filter(first)), ("b", rows.filter(~first))):
        bronze.append_bronze(part, f"{work}/bronze", t.ENDPOINT, LOADED_AT, load)
        loads.build_silver(spark, f"{work}/bronze", f"{work}/silver", now=LOADED_AT)
    return read_silver(spark, f"{work}/silver/reporter_summary", REPORTER_SUMMARY)


def endpoint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.landed_fields(t.bronze_preview(spark, sf_dir))
    return filter_endpoint(
        rows, t.ENDPOINT, reporterCode="3,7", period=f"{YEAR},199903", flowCode="X,M", cmdCode=None
    ).select("reporterCode", "partnerCode", "cmdCode", "flowCode", "period")


def retention_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "errors")
    deadletter.write_manifests(t.error_manifests(spark, sf_dir), path, RETENTION_NOW)
    maintenance.apply_retention(spark, path, RETENTION_NOW)
    return deadletter.scan_manifests(spark, path)


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "errors")
    deadletter.write_manifests(t.error_manifests(spark, sf_dir), path, RETENTION_NOW)
    return deadletter.manifest_counts(deadletter.scan_manifests(spark, path))


def pii_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pages = (t.table(spark, sf_dir, n) for n in ("documents", "pages"))
    documents = governance.pii_findings(documents, "documents", "doc_id")
    pages = governance.pii_findings(pages, "pages", "page_id")
    return documents.unionByName(pages)


def _on_points(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(t.metric_points(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "stg_preview": staged,
    "stg_mbs": lambda spark, sf_dir: stage_mbs(t.bronze_mbs(spark, sf_dir)),
    "trade_flows": flows,
    "reporter_summary": summary,
    "top_exporters": _on_summary(lambda s: q.top_exporters(s, YEAR, UNIT)),
    "top_commodities": _on_flows(lambda f: q.top_commodities(f, REPORTER, YEAR, UNIT)),
    "bilateral_flows": _on_flows(
        lambda f: q.bilateral_flows(f, REPORTER, PARTNER, COMMODITY, UNIT)
    ),
    "yoy_growth": _on_summary(lambda s: q.yoy_growth(s, BASE_YEAR, YEAR, UNIT)),
    "data_freshness": _on_summary(lambda s: q.data_freshness(s, UNIT)),
    "list_reporters": _on_summary(lambda s: q.list_reporters(s, YEAR)),
    "reporter_series": _on_summary(lambda s: q.reporter_series(s, REPORTER.lower())),
    "search_flows": _on_flows(
        lambda f: q.search_flows(f, reporter_iso=REPORTER, period=YEAR, flow_code="x")
    ),
    "bi_reporter_summary": _on_summary(extracts.bi_reporter_summary),
    "bi_trade_flows": _on_flows(extracts.bi_trade_flows),
    "api_trade_flows_view": _on_flows(lambda f: granted_view(f, "api", "trade_flows")),
    "endpoint_filter": endpoint_filter,
    "check_row_count": _check("check_row_count", min_rows=4000),
    "check_no_nulls": _check("check_no_nulls", required=("reporterCode", "period")),
    "check_non_negative": _check("check_numeric_non_negative", numeric=("primaryValue",)),
    "check_period_format": _check("check_period_format", freq=True),
    "check_no_duplicates": _check("check_no_duplicates", dedup=ENDPOINTS["preview"].dedup),
    "check_suite": check_suite,
    "gate_failures": gate_failures,
    "test_not_null": column_tests("not_null"),
    "test_accepted_values": column_tests("accepted_values"),
    "test_expression": column_tests("expression_is_true"),
    "test_negative_value": negative_values,
    "quarantine": quarantined,
    "source_freshness": source_freshness,
    "schema_drift": schema_drift,
    "incremental_guard": guarded("per_freq"),
    "guard_reference": guarded("reference"),
    "upsert_flows": _upsert(trade_flows, TRADE_FLOWS_KEY, TRADE_FLOWS, "flows"),
    "upsert_summary": _upsert(
        reporter_summary, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY, "summary"
    ),
    "backfill_status": backfill_status,
    "silver_build": silver_build,
    "validation_metrics": validation_metrics,
    "runlog_status": lambda spark, sf_dir: metrics.runlog_status(
        t.run_log(spark, sf_dir), by=("phase",)
    ),
    "daily_sums": _on_points(metrics.daily_sums),
    "failure_rate": _on_points(metrics.failure_rate),
    "avg_duration": _on_points(metrics.daily_average),
    "scan_alarm": _on_points(lambda p: metrics.scan_alarm(p, ALARM_LIMIT, ALARM_METRIC)),
    "lineage_edges": lambda spark, sf_dir: lineage_edges(t.lineage_events(spark, sf_dir)),
    "manifest_counts": manifest_counts,
    "retention_kept": retention_kept,
    "pii_findings": pii_findings,
}
