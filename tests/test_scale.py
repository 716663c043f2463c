"""Plan shapes and skewed inputs: what must hold when the data is much larger."""

import re

import pytest
from conftest import SF, flow, frame
from pyspark.sql import functions as F

import __spark_entry__ as driver
from ferrygate.filesystem import file_sizes
from ferrygate.operators.quality import CheckOptions, run_suite
from ferrygate.operators.silver import (
    flows_exact,
    guard_of,
    incremental,
    reporter_summary,
    summary_from_flows,
    trade_flows,
)
from ferrygate.operators.staging import stage_preview
from ferrygate.operators.upsert import merged_rows, read_silver, upsert
from ferrygate.schemas import ENDPOINTS, REPORTER_SUMMARY, TRADE_FLOWS, TRADE_FLOWS_KEY
from ferrygate.sources.bronze import append_bronze, read_bronze


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=6000):
    """A third of all rows from one reporter and period; nulls and repeats among them."""
    i = F.col("id")
    hot = i % 3 == 0
    text = lambda column: column.cast("string")
    return spark.range(n).select(
        F.lit("C").alias("typeCode"),
        F.lit("A").alias("freqCode"),
        F.when(hot, "2023").otherwise(text(2000 + i % 7)).alias("period"),
        F.when(hot, "840").otherwise(text(i % 11)).alias("reporterCode"),
        F.lit("ISO").alias("reporterISO"),
        F.lit("n").alias("reporterDesc"),
        F.when(i % 13 != 0, text(i % 17)).alias("partnerCode"),
        F.lit("P").alias("partnerISO"),
        F.lit("p").alias("partnerDesc"),
        F.when(i % 19 != 0, text(i % 23)).alias("cmdCode"),
        F.lit("c").alias("cmdDesc"),
        F.when(i % 2 == 0, "X").otherwise("M").alias("flowCode"),
        F.lit("f").alias("flowDesc"),
        F.when(i % 29 == 0, F.lit(None)).when(i % 31 == 0, "-1.5").otherwise(
            text(i / 100)).alias("primaryValue"),
    )


def by_hand(rows):
    groups = {}
    for r in rows:
        if r["primaryValue"] is None or float(r["primaryValue"]) < 0:
            continue
        g = groups.setdefault((r["period"], int(r["reporterCode"])), [0, 0, 0, set(), set()])
        cents = round(float(r["primaryValue"]) * 100)
        g[0] += cents * (r["flowCode"] == "X")
        g[1] += cents * (r["flowCode"] == "M")
        g[2] += cents
        g[3].add(r["cmdCode"])
        g[4].add(r["partnerCode"])
    return {
        key: (x / 100, m / 100, t / 100, (x - m) / 100, len(c - {None}), len(p - {None}))
        for key, (x, m, t, c, p) in groups.items()
    }


def measures(df):
    return {(r["period"], r["reporter_code"]): tuple(r)[5:] for r in df.collect()}


def test_summary_of_skewed_rows(spark):
    rows = skewed(spark)
    expected = by_hand(rows.collect())
    staged = stage_preview(rows)
    assert measures(reporter_summary(staged)) == expected
    assert measures(summary_from_flows(flows_exact(staged))) == expected


def test_checks_of_skewed_rows(spark):
    rows = skewed(spark).withColumn("endpoint", F.lit("preview")).withColumn("run_id", F.lit("r"))
    plain = rows.collect()
    got = {r["name"]: r for r in run_suite(rows, CheckOptions.of(ENDPOINTS["preview"], F.lit("A"))).collect()}
    keys = [tuple(r[k] for k in ENDPOINTS["preview"].dedup) for r in plain]
    repeated = got["check_no_duplicates"]["details"]["duplicate_count"]
    assert int(repeated) == len(keys) - len(set(keys))
    negative = sum(r["primaryValue"] == "-1.5" for r in plain)
    assert got["check_numeric_non_negative"]["details"] == {"negative.primaryValue": str(negative)}


def test_large_period_is_split_over_files(spark, root):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64KB")
    try:
        rows = skewed(spark, 30000).withColumn("cmdDesc", F.sha2(F.col("primaryValue"), 256))
        append_bronze(rows, root, "preview", "2024-01-01T00:00:00+00:00")
    finally:
        spark.conf.unset(key)
    per_period = file_sizes(spark, f"{root}/preview").groupBy(
        F.regexp_extract("path", "period=([0-9]+)", 1).alias("p")).count()
    counts = {r["p"]: r["count"] for r in per_period.collect()}
    assert counts["2023"] > 1
    assert read_bronze(spark, root, "preview").count() == 30000


def test_upsert_is_an_equi_join(spark, root, no_broadcast):
    flows = trade_flows(stage_preview(skewed(spark)))
    upsert(flows, root + "/t", TRADE_FLOWS_KEY, TRADE_FLOWS)
    target = read_silver(spark, root + "/t", TRADE_FLOWS)
    text = plan(merged_rows(target, flows, TRADE_FLOWS_KEY))
    assert "SortMergeJoin" in text and "LeftAnti" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_guard_prunes_bronze_folders(spark, root):
    rows = frame(spark, [flow(period="2022"), flow(period="2023"), flow(period="202301", freqCode="M")])
    append_bronze(rows, root, "preview", "2024-01-01T00:00:00+00:00")
    guard = guard_of(spark.createDataFrame([("A", "2023"), ("M", "202301")], "freq_code string, period string"))
    staged = incremental(stage_preview(read_bronze(spark, root, "preview")), guard, "per_freq")
    text = plan(staged)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "2023" in filters or staged.filter("period = '2022'").count() == 0
    assert "period" in filters


def test_served_query_prunes_and_pushes(spark, root):
    from ferrygate.plans.queries import search_flows

    upsert(trade_flows(stage_preview(skewed(spark))), root + "/t", TRADE_FLOWS_KEY, TRADE_FLOWS)
    df = search_flows(read_silver(spark, root + "/t", TRADE_FLOWS), reporter_iso="ISO", period="2023")
    text = plan(df)
    assert "EqualTo(freq_code,A)" in text and "EqualTo(reporter_iso,ISO)" in text
    assert "(period" in re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    assert "source_record_count" not in re.search(r"ReadSchema: (.*)", text).group(1)


LAZY = [
    "stg_preview", "stg_mbs", "trade_flows", "reporter_summary", "top_exporters", "yoy_growth",
    "check_no_duplicates", "check_period_format", "lineage_edges", "pii_findings", "daily_sums",
    "scan_alarm", "failure_rate", "quarantine",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, no_broadcast, name):
    text = plan(driver.queries()[name](spark, SF))
    for word in ("NestedLoop", "Cartesian", "Python", "Pandas", "SinglePartition"):
        if word == "SinglePartition" and name in ("top_exporters", "yoy_growth"):
            continue
        assert word not in text


def test_read_schema_is_pruned(spark):
    text = plan(driver.queries()["reporter_summary"](spark, SF))
    schema = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_orderkey" in s)
    assert "l_tax" not in schema and "l_quantity" not in schema and "l_linenumber" not in schema
    assert REPORTER_SUMMARY.names[0] == "period"
