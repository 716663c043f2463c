import pytest
from conftest import flow, frame
from pyspark.errors import AnalysisException

from ferrygate.operators.coltests import (
    ColumnTestError,
    assert_column_tests,
    negative_values,
    run_column_tests,
)
from ferrygate.operators.freshness import StaleSource, assert_fresh, source_freshness
from ferrygate.operators.silver import reporter_summary, trade_flows
from ferrygate.operators.staging import granted_view, rejected_preview, stage_mbs, stage_preview
from ferrygate.schemas import REPORTER_SUMMARY, STG_MBS, STG_PREVIEW, TRADE_FLOWS


def types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_stage_preview(spark):
    rows = [flow(), flow(reporterCode=None), flow(period=None), flow(partnerCode=None)]
    staged = stage_preview(frame(spark, rows))
    assert types(staged.schema) == types(STG_PREVIEW)
    assert staged.count() == 2
    assert staged.first()["reporter_code"] == 578


def test_bad_cast_fails_unless_lenient(spark):
    bad = frame(spark, [flow(), flow(reporterCode="abc"), flow(primaryValue="n/a")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_preview(bad).collect()
    assert stage_preview(bad, lenient=True).count() == 1
    assert rejected_preview(bad).count() == 2


def test_stage_mbs_needs_only_period(spark):
    rows = frame(spark, [flow(reporterCode=None), flow(period=None)])
    mbs = rows.selectExpr("*", "'T35' as seriesType", "'x' as seriesDesc")
    staged = stage_mbs(mbs)
    assert types(staged.schema) == types(STG_MBS) and staged.count() == 1


SILVER = [
    flow(primaryValue="10"),
    flow(primaryValue="5"),
    flow(flowCode="M", flowDesc="Import", primaryValue="4"),
    flow(flowCode="Re-Export", flowDesc="Re-Export", primaryValue="2", partnerCode=None),
    flow(primaryValue="-7"),
    flow(primaryValue=None),
    flow(cmdCode=None, primaryValue="1"),
]


def test_trade_flows(spark):
    flows = trade_flows(stage_preview(frame(spark, SILVER)))
    assert types(flows.schema) == types(TRADE_FLOWS)
    got = {
        (r["flow_code"], r["partner_code"], r["commodity_code"]): (
            r["trade_value_usd"], r["source_record_count"],
        )
        for r in flows.collect()
    }
    assert got == {
        ("X", 858, "0305"): (15.0, 2),
        ("M", 858, "0305"): (4.0, 1),
        ("Re-Export", None, "0305"): (2.0, 1),
        ("X", 858, None): (1.0, 1),
    }


def test_reporter_summary(spark):
    summary = reporter_summary(stage_preview(frame(spark, SILVER)))
    assert types(summary.schema) == types(REPORTER_SUMMARY)
    row = summary.collect()[0]
    assert (row["export_value_usd"], row["import_value_usd"]) == (16.0, 4.0)
    assert (row["total_trade_value_usd"], row["trade_balance_usd"]) == (22.0, 12.0)
    assert (row["commodity_count"], row["partner_count"]) == (1, 1)


def test_sum_does_not_depend_on_order(spark):
    rows = [flow(primaryValue=v) for v in ("1e15", "0.1", "-0", "0.2", "0.3")] * 3
    one = trade_flows(stage_preview(frame(spark, rows).repartition(1))).first()
    other = trade_flows(stage_preview(frame(spark, rows[::-1]).repartition(4))).first()
    assert one["trade_value_usd"] == other["trade_value_usd"] == 3000000000000001.8


def test_grants(spark):
    flows = trade_flows(stage_preview(frame(spark, SILVER)))
    view = granted_view(flows, "api", "trade_flows")
    assert len(view.columns) == 10 and "flow_name" not in view.columns
    with pytest.raises(AnalysisException):
        view.select("reporter_code")
    assert granted_view(flows, "bi", "trade_flows").columns == flows.columns
    with pytest.raises(PermissionError):
        granted_view(flows, "guest", "trade_flows")


def test_column_tests(spark):
    staged = stage_preview(frame(spark, [flow(flowCode="ZZ"), flow(partnerCode=None, freqCode=None)]))
    results = run_column_tests(staged, "stg_preview")
    got = {(r["test"], r["column_name"]): r["failures"] for r in results.collect()}
    assert got["not_null", "partner_code"] == 1 and got["not_null", "period"] == 0
    assert got["accepted_values", "flow_code"] == 1 and got["accepted_values", "freq_code"] == 0
    with pytest.raises(ColumnTestError, match="stg_preview.flow_code accepted_values: 1 row"):
        assert_column_tests(results)


def test_expression_ignores_null(spark):
    schema = "period string, reporter_code int, export_value_usd double, import_value_usd double"
    df = spark.createDataFrame([("2023", 1, -1.0, None)], schema)
    got = {r["column_name"]: r["failures"]
           for r in run_column_tests(df, "reporter_summary", "expression_is_true").collect()}
    assert got == {"export_value_usd": 1, "import_value_usd": 0}


def test_negative_values(spark):
    rows = negative_values(stage_preview(frame(spark, SILVER))).collect()
    assert [r["trade_value_usd"] for r in rows] == [-7.0]


@pytest.mark.parametrize(
    "now, status",
    [
        ("2024-01-27T00:00:00+00:00", "pass"),
        ("2024-01-27T00:00:01+00:00", "warn"),
        ("2024-02-05T00:00:00+00:00", "warn"),
        ("2024-02-05T00:00:01+00:00", "error"),
    ],
)
def test_freshness_limits(spark, now, status):
    stamps = [("2023-12-01T00:00:00+00:00",), ("2024-01-01T00:00:00+00:00",)]
    report = source_freshness(spark.createDataFrame(stamps, "_loaded_at string"), "preview", now)
    assert report.first()["status"] == status
    if status == "error":
        with pytest.raises(StaleSource):
            assert_fresh(report)
    else:
        assert_fresh(report)


def test_never_loaded_is_an_error(spark):
    report = source_freshness(spark.createDataFrame([], "_loaded_at string"), "t", "2024-01-01")
    assert report.first()["status"] == "error"
