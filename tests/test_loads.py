import json

import pytest
from conftest import as_dicts, flow, frame
from pyspark.sql import functions as F

from ferrygate.operators.coltests import ColumnTestError
from ferrygate.operators.freshness import StaleSource
from ferrygate.operators.lineage import lineage_edges
from ferrygate.operators.upsert import read_silver
from ferrygate.plans.loads import (
    observed_build,
    BackfillError,
    backfill,
    build_silver,
    ingest,
    validate_backfill,
)
from ferrygate.schemas import REPORTER_SUMMARY, TRADE_FLOWS
from ferrygate.sources.bronze import append_bronze, read_bronze
from ferrygate.sources.deadletter import scan_manifests
from ferrygate.sources.envelopes import parse_record_lines, read_envelopes, scan_raw

NOW = "2024-03-01T00:00:00+00:00"


def land(base, run, records, endpoint="preview", freq="A", text=None):
    folder = base / f"raw/{endpoint}/type=C/freq={freq}/year=2024/month=03"
    folder.mkdir(parents=True, exist_ok=True)
    body = text if text is not None else json.dumps({"count": len(records), "data": records})
    (folder / f"{run}.json").write_text(body, encoding="utf-8")


def run_ingest(spark, base, load="l1"):
    landed = read_envelopes(spark, f"{base}/raw")
    return ingest(landed, f"{base}/bronze", f"{base}/state", NOW, load)


def test_good_runs_load_and_bad_runs_are_dead_lettered(spark, tmp_path):
    land(tmp_path, "good", [flow(primaryValue=1.5), flow(flowCode="M", primaryValue=2)])
    land(tmp_path, "monthly", [flow(period="202301", freqCode="M")], freq="M")
    land(tmp_path, "nulls", [flow(reporterCode=None)])
    land(tmp_path, "wrongshape", [flow(period="202301")])
    land(tmp_path, "broken", [], text="{oops")
    land(tmp_path, "share", [{"reporterCode": "1", "period": "2023", "share": -1, "x": 1}], "getWorldShare")
    report = run_ingest(spark, tmp_path)
    rows = read_bronze(spark, f"{tmp_path}/bronze", "preview").collect()
    assert sorted(r["primaryValue"] for r in rows) == ["1.5", "100.5", "2"]
    assert {r["_loaded_at"] for r in rows} == {NOW}
    share = read_bronze(spark, f"{tmp_path}/bronze", "getWorldShare").first()
    assert share["share"] == "-1" and share["_extra"] == {"x": "1"}
    letters = {r["run_id"]: r for r in scan_manifests(spark, f"{tmp_path}/state/errors").collect()}
    assert set(letters) == {"nulls", "wrongshape", "broken"}
    assert "check_no_nulls" in letters["nulls"]["exception_message"]
    assert letters["broken"]["exception_type"] == "DataQualityError"
    assert (letters["nulls"]["year"], letters["nulls"]["month"]) == ("2024", "03")
    assert report.failures.count() == 3
    points = spark.read.parquet(f"{tmp_path}/state/metrics")
    failed = points.filter("metric = 'ChecksFailed' AND value > 0").count()
    assert failed >= 3 and points.filter("metric = 'JsonBytesWritten'").count() == 6
    edges = lineage_edges(spark.read.parquet(f"{tmp_path}/state/lineage")).collect()
    assert sorted(e["job"] for e in edges) == [
        "ingest_getWorldShare.append_bronze", "ingest_preview.append_bronze", "ingest_preview.append_bronze",
    ]


def test_repeated_load_does_not_double_rows(spark, tmp_path):
    land(tmp_path, "a", [flow()])
    run_ingest(spark, tmp_path)
    run_ingest(spark, tmp_path)
    assert read_bronze(spark, f"{tmp_path}/bronze", "preview").count() == 1
    run_ingest(spark, tmp_path, "l2")
    assert read_bronze(spark, f"{tmp_path}/bronze", "preview").count() == 2


def test_drift_is_seen_before_the_gate(spark, tmp_path):
    land(tmp_path, "a", [flow()])
    assert run_ingest(spark, tmp_path).drift.count() == 0
    land(tmp_path, "b", [flow(period=None, newField=1)])
    drift = run_ingest(spark, tmp_path, "l2").drift.collect()
    assert [(r["column_name"], r["change"]) for r in drift] == [("newField", "added")]


def test_one_run_id_in_two_months_is_judged_per_file(spark, tmp_path):
    land(tmp_path, "same", [flow()])
    folder = tmp_path / "raw/preview/type=C/freq=A/year=2024/month=04"
    folder.mkdir(parents=True)
    (folder / "same.json").write_text('{"data": []}')
    report = ingest(scan_raw(spark, f"{tmp_path}/raw", "preview"), f"{tmp_path}/bronze",
                    f"{tmp_path}/state", NOW, "x")
    assert report.failures.count() == 1
    assert read_bronze(spark, f"{tmp_path}/bronze", "preview").count() == 1


@pytest.mark.parametrize(
    "conf",
    [{}, {"periods": ["2020"]}, {"endpoint": "preview"}, {"endpoint": "preview", "periods": []},
     {"endpoint": "preview", "periods": "2020"}, {"endpoint": "getDA", "periods": ["2020"]}],
)
def test_backfill_request_is_checked_first(conf):
    with pytest.raises(ValueError):
        validate_backfill(conf)


def test_backfill_defaults():
    request = validate_backfill({"endpoint": "preview", "periods": ["2020", "202101"]})
    assert (request.type_code, request.freq_code, request.cl_code) == ("C", "A", "HS")


def test_backfill(spark, tmp_path):
    rows = frame(spark, [
        flow(period="2020"), flow(period="2020", flowCode="M"), flow(period="202101", freqCode="M"),
        flow(period="2021", reporterCode=None), flow(period="2021"), flow(period="1999"),
    ])
    conf = {"endpoint": "preview", "periods": ["2020", "2021", "202101", "2022"], "freq_code": None}
    bronze = f"{tmp_path}/bronze"
    with pytest.raises(BackfillError) as caught:
        backfill(rows, conf, bronze, NOW)
    assert caught.value.failed == ["2021", "2022"]
    status = as_dicts(backfill(rows, conf, bronze, NOW, strict=False), "period")
    assert [(s["period"], s["status"], s["rows"]) for s in status] == [
        ("2020", "success", 2), ("2021", "error", 2), ("202101", "success", 1), ("2022", "error", 0),
    ]
    assert "check_no_nulls" in status[1]["error"]
    loaded = read_bronze(spark, bronze, "preview").collect()
    assert sorted(r["period"] for r in loaded) == ["2020", "2020", "202101"]


def test_backfill_with_a_named_frequency(spark, tmp_path):
    rows = frame(spark, [flow(period="2020"), flow(period="202101", freqCode="M")])
    conf = {"endpoint": "preview", "periods": ["2020", "202101"], "freq_code": "A"}
    status = as_dicts(backfill(rows, conf, f"{tmp_path}/b", NOW, strict=False), "period")
    assert [s["status"] for s in status] == ["success", "error"]


def test_record_lines_load_like_envelopes(spark, tmp_path):
    land(tmp_path, "good", [], text="\n".join(json.dumps(flow(cmdCode=i)) for i in range(3)))
    land(tmp_path, "bad", [], text=json.dumps(flow()) + "\n{oops")
    lines = parse_record_lines(scan_raw(spark, f"{tmp_path}/raw", "preview", whole=False))
    report = ingest(lines, f"{tmp_path}/bronze", f"{tmp_path}/state", NOW, "x")
    assert [r["run_id"] for r in report.failures.collect()] == ["bad"]
    assert read_bronze(spark, f"{tmp_path}/bronze", "preview").count() == 3


def test_backfill_filters_codes(spark, tmp_path):
    rows = frame(spark, [flow(period="2020"), flow(period="2020", reporterCode="1")])
    conf = {"endpoint": "preview", "periods": ["2020"], "reporter_code": "1,2"}
    assert as_dicts(backfill(rows, conf, f"{tmp_path}/b", NOW))[0]["rows"] == 1


def silver(spark, base, name, schema):
    return {
        (r["period"], r["flow_code"] if "flow_code" in r.asDict() else r["reporter_code"]): r
        for r in read_silver(spark, f"{base}/silver/{name}", schema).collect()
    }


def build(spark, base, **kw):
    return build_silver(spark, f"{base}/bronze", f"{base}/silver", now=NOW, **kw)


def add(spark, base, load, *records):
    append_bronze(frame(spark, records), f"{base}/bronze", "preview", NOW, load)


def test_silver_build_sequence(spark, tmp_path):
    add(spark, tmp_path, "1", flow(period="2022", primaryValue=1), flow(period="2023", primaryValue=1))
    assert build(spark, tmp_path)["trade_flows"] == ["2022", "2023"]

    # Late rows of the newest period count again; rows of an older one wait for a named period.
    add(spark, tmp_path, "2", flow(period="2022", primaryValue=9), flow(period="2023", primaryValue=2))
    assert build(spark, tmp_path)["trade_flows"] == ["2023"]
    got = silver(spark, tmp_path, "trade_flows", TRADE_FLOWS)
    assert got["2022", "X"]["trade_value_usd"] == 1.0
    assert (got["2023", "X"]["trade_value_usd"], got["2023", "X"]["source_record_count"]) == (3.0, 2)

    build(spark, tmp_path, periods=["2022"])
    assert silver(spark, tmp_path, "trade_flows", TRADE_FLOWS)["2022", "X"]["trade_value_usd"] == 10.0
    summary = silver(spark, tmp_path, "reporter_summary", REPORTER_SUMMARY)
    assert summary["2022", 578]["export_value_usd"] == 10.0


def test_monthly_load_does_not_hide_annual_rows(spark, tmp_path):
    add(spark, tmp_path, "1", flow(period="202301", freqCode="M"))
    build(spark, tmp_path)
    add(spark, tmp_path, "2", flow(period="2023"))
    assert build(spark, tmp_path, guard="reference")["trade_flows"] == ["202301"]
    assert build(spark, tmp_path)["trade_flows"] == ["2023", "202301"]


def test_tables_at_different_guards(spark, tmp_path):
    add(spark, tmp_path, "1", flow(period="2022"), flow(period="2023"))
    build(spark, tmp_path)
    from ferrygate.filesystem import remove_folder

    remove_folder(spark, f"{tmp_path}/silver/reporter_summary")
    done = build(spark, tmp_path)
    assert done == {"trade_flows": ["2023"], "reporter_summary": ["2022", "2023"]}


def test_full_refresh(spark, tmp_path):
    add(spark, tmp_path, "1", flow(period="2022"), flow(period="2023"))
    build(spark, tmp_path)
    assert build(spark, tmp_path, full_refresh=True)["reporter_summary"] == ["2022", "2023"]


def test_null_keys_do_not_pile_up(spark, tmp_path):
    add(spark, tmp_path, "1", flow(cmdCode=None))
    build(spark, tmp_path)
    build(spark, tmp_path)
    assert read_silver(spark, f"{tmp_path}/silver/trade_flows", TRADE_FLOWS).count() == 1


def test_build_stops_on_stale_source_and_on_failed_tests(spark, tmp_path):
    add(spark, tmp_path, "1", flow(flowCode="ZZ"))
    with pytest.raises(StaleSource):
        build_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", now="2025-01-01T00:00:00+00:00")
    assert read_silver(spark, f"{tmp_path}/silver/trade_flows", TRADE_FLOWS) is None
    with pytest.raises(ColumnTestError, match="accepted_values"):
        build(spark, tmp_path)


def test_build_with_bulletin(spark, tmp_path):
    add(spark, tmp_path, "1", flow())
    mbs = frame(spark, [flow()]).select(
        "period", "freqCode", F.lit("T35").alias("seriesType"), F.lit("s").alias("seriesDesc"),
        "reporterCode", "reporterISO", "reporterDesc", "primaryValue",
    )
    append_bronze(mbs, f"{tmp_path}/bronze", "getMBS", NOW)
    build(spark, tmp_path, sources=("preview", "getMBS"))


def test_a_failing_build_leaves_metrics_and_a_dead_letter(spark, tmp_path):
    add(spark, tmp_path, "1", flow(partnerCode=None))
    for _ in range(2):
        with pytest.raises(Exception, match="partner"):
            observed_build(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/state", "x", now=NOW)
    points = {(r["dims"]["Phase"], r["metric"]): r["value"] for r in spark.read.parquet(f"{tmp_path}/state/metrics").collect()}
    assert len(points) == 9 and points["test", "DbtTestsFailed"] >= 1 and points["run", "DbtModelsErrored"] == 0
    letters = spark.read.json(f"{tmp_path}/state/errors").collect()
    assert [(r["task_id"], r["exception_type"]) for r in letters] == [("test", "ColumnTestError")]
