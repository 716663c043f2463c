import uuid
from urllib.parse import urlparse

import pytest
from conftest import as_dicts, flow, frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrygate.functions.text import name_uuid, safe_run_id, uri_name, uri_namespace
from ferrygate.operators.lineage import lineage_edges, run_events
from ferrygate.operators.metrics import (
    BYTES_PER_GB,
    daily_average,
    daily_sums,
    failure_rate,
    metric_points,
    runlog_status,
    scan_alarm,
    validation_metrics,
)
from ferrygate.operators.quality import CheckOptions, run_suite
from ferrygate.sources.deadletter import (
    MANIFEST_FIELDS,
    manifest_counts,
    manifests,
    scan_manifests,
    write_manifests,
)

NOW = "2024-03-05T00:00:00+00:00"


def points(spark, *rows):
    """(timestamp text, metric, value, dims)"""
    df = spark.createDataFrame(list(rows), "t string, metric string, value double, dims map<string,string>")
    return df.withColumn("ts", F.to_timestamp("t"))


D = {"DagId": "d", "Endpoint": "e"}


def test_daily_sums_and_dimension_order(spark):
    df = points(
        spark,
        ("2024-01-01 01:00:00", "RowCount", 1.0, {"DagId": "d", "Endpoint": "e"}),
        ("2024-01-01 23:59:59", "RowCount", 2.0, {"Endpoint": "e", "DagId": "d"}),
        ("2024-01-02 00:00:00", "RowCount", 4.0, D), ("2024-01-02 00:00:00", "Other", 9.0, D),
    )
    got = [(str(r["day"]), r["dims"], r["total"]) for r in as_dicts(daily_sums(df), "day")]
    assert got == [("2024-01-01", "DagId=d,Endpoint=e", 3.0), ("2024-01-02", "DagId=d,Endpoint=e", 4.0)]


def test_failure_rate(spark):
    df = points(
        spark,
        ("2024-01-01 01:00:00", "ChecksPassed", 3.0, D), ("2024-01-01 02:00:00", "ChecksFailed", 1.0, D),
        ("2024-01-02 01:00:00", "ChecksPassed", 0.0, D),
    )
    got = [r["failure_rate_pct"] for r in as_dicts(failure_rate(df), "day")]
    assert got == [25.0, None]


def test_average(spark):
    df = points(spark, *(("2024-01-01 01:00:00", "DbtRunDuration", v, {"Phase": "p"}) for v in (1.0, 2.0)))
    assert daily_average(df).first()["average"] == 1.5


def test_alarm_is_strict_and_per_window(spark):
    limit = 5 * BYTES_PER_GB
    df = points(
        spark,
        ("2024-01-01 00:00:00", "ProcessedBytes", float(limit), {}),
        ("2024-01-01 00:05:00", "ProcessedBytes", float(limit), {}),
        ("2024-01-01 00:09:59", "ProcessedBytes", 1.0, {}), ("2024-01-01 00:06:00", "Other", 9e20, {}),
    )
    rows = scan_alarm(df, limit, "ProcessedBytes").collect()
    assert [(str(r["window_start"]), r["total"]) for r in rows] == [("2024-01-01 00:05:00", limit + 1.0)]


def test_validation_metrics(spark):
    rows = frame(spark, [flow(), flow(period=None)]).select(
        F.lit("preview").alias("endpoint"), F.lit("r").alias("run_id"), F.lit(77).alias("file_size"),
        F.lit("/f").alias("file_path"), "*",
    )
    results = run_suite(rows, CheckOptions(required=("period",)))
    got = {r["metric"]: (r["value"], r["unit"]) for r in validation_metrics(results).collect()}
    assert got == {
        "RowCount": (2.0, "Count"), "ChecksPassed": (1.0, "Count"), "ChecksFailed": (1.0, "Count"),
        "JsonBytesWritten": (77.0, "Bytes"),
    }
    small = run_suite(rows.drop("file_size", "file_path"), CheckOptions())
    assert validation_metrics(small).count() == 3
    assert validation_metrics(results.filter("name <> 'check_row_count'")).filter(
        "metric = 'RowCount'").first()["value"] == 0.0
    dims = metric_points(validation_metrics(small), F.lit("dag"), F.lit(NOW)).first()["dims"]
    assert dims == {"DagId": "dag", "Endpoint": "preview"}


def test_run_log(spark):
    def line(status):
        return f'{{"data": {{"node_info": {{"node_status": "{status}"}}}}}}'

    lines = [line("error"), line("fail"), line("fail"), line("success"), "not json", "", "[1]", "3",
             '{"data": null}', '{"data": "x"}', line("error")[:-2], line("error") + " tail"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert tuple(runlog_status(df).first()) == (1, 2)


def plain_split(uri):
    if uri.startswith("s3://"):
        bucket, slash, key = uri[5:].partition("/")
        return f"s3://{bucket}", key if slash else "/"
    if uri.startswith(("http://", "https://")):
        parts = urlparse(uri)
        return f"{parts.scheme}://{parts.netloc}", parts.path or "/"
    return uri, "/"


def test_uris(spark):
    uris = ["s3://b/k/x.json", "s3://b", "s3://b/", "https://h/p/q?x=1#f", "http://h", "https://h?x=1",
            "file:///tmp/x", "plain", "https://h:8080/p", "s3://b/a?b#c"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    got = df.select("u", uri_namespace(F.col("u")), uri_name(F.col("u"))).collect()
    assert [(r[1], r[2]) for r in got] == [plain_split(r[0]) for r in got]


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=20), min_size=30, max_size=30))
def test_name_uuid_matches_the_library(spark, names):
    names = [n for n in names if not any(0xD800 <= ord(c) <= 0xDFFF for c in n)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", name_uuid(F.col("n"))).collect()
    assert [r[1] for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, r[0])) for r in got]


def test_edges(spark):
    tasks = spark.createDataFrame(
        [("d", "t", "run1", NOW, ["s3://b/a", "s3://b/c"], ["s3://b/o"]), ("d", "check", "run1", NOW, ["s3://b/o"], [])],
        "dag_id string, task_id string, run_id string, event_time string, input_uris array<string>, output_uris array<string>",
    )
    events = run_events(tasks, "trade", "urn:test")
    assert events.first()["job"]["name"] == "d.t" and events.first()["eventType"] == "COMPLETE"
    edges = lineage_edges(events).collect()
    assert sorted((e["job"], e["input_name"], e["output_name"]) for e in edges) == [("d.t", "a", "o"), ("d.t", "c", "o")]
    assert edges[0]["run_id"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "run1"))


def test_manifests(spark, root):
    rows = spark.createDataFrame(
        [("d", "t", "run:1+0", "2023-07-01T00:00:00", "ValueError", "bad"), ("d", "t", None, None, None, None)],
        "dag_id string, task_id string, run_id string, execution_date string, exception_type string, exception_message string",
    )
    shaped = manifests(rows, NOW)
    assert tuple(shaped.columns) == MANIFEST_FIELDS and len(MANIFEST_FIELDS) == 8
    write_manifests(shaped, root + "/e", NOW)
    write_manifests(shaped.filter("run_id = 'run:1+0'").withColumn("failed_at", F.lit("2024-03-06")), root + "/e", NOW)
    got = scan_manifests(spark, root + "/e").collect()
    assert {(r["run_id"], r["year"], r["month"]) for r in got} == {("run:1+0", "2023", "07"), ("unknown", "2024", "03")}
    assert len(got) == 3
    newest = {r["run_id"]: r["failed_at"] for r in scan_manifests(spark, root + "/e", latest=True).collect()}
    assert newest == {"run:1+0": "2024-03-06", "unknown": NOW}
    counts = {r["exception_type"]: r["failures"] for r in manifest_counts(scan_manifests(spark, root + "/e")).collect()}
    assert counts == {"ValueError": 2, None: 1}
    assert shaped.select(safe_run_id(F.col("run_id"))).first()[0] == "run-1-0"


@pytest.mark.parametrize("part", ["dag_id=d", "task_id=t"])
def test_manifest_layout(spark, root, part):
    write_manifests(manifests(spark.createDataFrame([("d", "t")], "dag_id string, task_id string"), NOW), root + "/e", NOW)
    path = spark.read.text(root + "/e").select("_metadata.file_path")
    assert f"/{part}/" in path.first()[0] and "/year=2024/month=03/" in path.first()[0]
