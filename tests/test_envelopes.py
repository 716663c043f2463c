import json

import pytest
from pyspark.sql import functions as F

from ferrygate.sources.envelopes import (
    explode_records,
    filter_endpoint,
    parse_record_lines,
    raw_folders,
    read_envelopes,
    scan_raw,
    typed_records,
    with_envelope_columns,
)

CASES = {
    "object": ('{"elapsedMs": 42, "count": 2, "data": [{"a": 1}, {"a": null, "b": "é"}]}', 2),
    "list": ('[{"a": 1}]', 1),
    "no_data": ('{"message": "x", "count": 0}', 0),
    "data_object": ('{"data": {"a": 1}}', 0),
    "data_null": ('{"data": null}', 0),
    "text": ('"hello"', 0),
    "number": ("12", 0),
    "garbage": ("{not json", 0),
    "trailing": ('{"data": [{"a": 1}]} tail', 0),
    "two": ('{"data": []} {"data": []}', 0),
    "listed_twice": ('{"data": []}, {"data": []}', 0),
    "blank": ("", 0),
    "empty": ('{"data": []}', 0),
    "padded": ('\n  {"data": [{"a": 1}]} \n', 1),
}
KINDS = {
    "object": "object", "list": "list", "no_data": "object", "data_object": "object",
    "data_null": "object", "text": "other", "number": "other", "garbage": None, "trailing": None,
    "two": None, "listed_twice": None, "blank": None, "empty": "object", "padded": "object",
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, text) for name, (text, _) in CASES.items()]
    df = with_envelope_columns(spark.createDataFrame(rows, "name string, value string"))
    return {r["name"]: r.asDict(recursive=True) for r in df.collect()}


@pytest.mark.parametrize("name", CASES)
def test_kind_and_records(parsed, name):
    assert parsed[name]["kind"] == KINDS[name]
    assert len(parsed[name]["records"]) == CASES[name][1]


def test_flags(parsed):
    assert parsed["object"]["elapsed_ms"] == 42 and parsed["object"]["declared_count"] == 2
    assert parsed["no_data"]["has_data"] is False
    assert parsed["no_data"]["keys_present"] == "message, count"
    assert parsed["data_null"]["has_data"] is True and parsed["data_null"]["data_is_list"] is False
    assert parsed["empty"]["data_is_list"] is True


def test_record_values_keep_null_keys(parsed):
    assert parsed["object"]["records"] == [{"a": "1"}, {"a": None, "b": "é"}]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def zone(tmp_path):
    base = tmp_path / "raw"
    write(base / "preview/type=C/freq=A/year=2023/month=01/run-1.json", CASES["object"][0])
    write(base / "preview/type=C/freq=M/year=2023/month=02/run-2.json", CASES["list"][0])
    write(base / "getMBS/series_type=T35/year=2024/month=11/run-3.json", CASES["empty"][0])
    write(base / "getReleases/year=2024/month=01/run-4.json", CASES["garbage"][0])
    return str(base)


def test_scan_of_all_endpoints(spark, zone):
    rows = {r["run_id"]: r for r in read_envelopes(spark, zone).collect()}
    assert set(rows) == {"run-1", "run-2", "run-3", "run-4"}
    first = rows["run-1"]
    assert (first["endpoint"], first["type"], first["freq"]) == ("preview", "C", "A")
    assert (first["year"], first["month"]) == ("2023", "01")
    assert rows["run-3"]["series_type"] == "T35" and rows["run-3"]["type"] is None
    assert rows["run-4"]["kind"] is None
    assert first["file_size"] == len(CASES["object"][0].encode())


def test_scan_of_one_endpoint_keeps_text_dimensions(spark, zone):
    df = scan_raw(spark, zone, "preview")
    assert dict(df.dtypes)["month"] == "string"
    got = {(r["run_id"], r["month"]) for r in df.filter("freq = 'M'").collect()}
    assert got == {("run-2", "02")}


def test_given_dimensions_limit_the_listing(spark, zone):
    files = scan_raw(spark, zone, "preview", month="01").inputFiles()
    assert [f.rsplit("/", 1)[1] for f in files] == ["run-1.json"]
    assert raw_folders("/z", "getMBS", year="2024") == "/z/getMBS/series_type=*/year=2024"
    assert raw_folders("/z/", "preview") == "/z/preview"
    with pytest.raises(ValueError):
        raw_folders("/z", "getReleases", freq="A")


def test_explode_keeps_runs_without_records(spark, zone):
    rows = explode_records(read_envelopes(spark, zone), keep_empty=True).collect()
    assert sum(r["is_record"] for r in rows) == 3
    assert {r["run_id"] for r in rows if not r["is_record"]} == {"run-3", "run-4"}


def test_typed_records_put_unknown_fields_aside(spark):
    text = json.dumps({"data": [{"reporterCode": 578, "period": "2023", "odd": [1]}, 5]})
    env = with_envelope_columns(spark.createDataFrame([(text,)], "value string"))
    rows = typed_records(explode_records(env), "preview").collect()
    assert rows[0]["reporterCode"] == "578" and rows[0]["_extra"] == {"odd": "[1]"}
    assert rows[1]["reporterCode"] is None and rows[1]["_extra"] is None


def test_unregistered_endpoint_keeps_everything(spark):
    env = with_envelope_columns(spark.createDataFrame([('[{"x": 1}]',)], "value string"))
    assert typed_records(explode_records(env), "getSomething").collect()[0]["_extra"] == {"x": "1"}


def test_record_lines(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ("",), ("oops",)], "value string")
    assert [r["fields"] for r in parse_record_lines(lines).collect()] == [{"a": "1"}, None]


def test_endpoint_filter(spark):
    rows = spark.createDataFrame(
        [("578", "2023", "X"), ("858", "2023", "M"), ("36", "2022", "X")],
        "reporterCode string, period string, flowCode string",
    )
    got = filter_endpoint(rows, "preview", reporterCode="578, 36", flowCode=None)
    assert {r[0] for r in got.collect()} == {"578", "36"}
    with pytest.raises(ValueError):
        filter_endpoint(rows, "preview", motCode="1")


def test_bulletin_filters(spark):
    rows = spark.createDataFrame(
        [("2023", "T35", {"tableType": "a"}), ("202301", "T35", None), ("2022", "T38", None)],
        "period string, seriesType string, _extra map<string,string>",
    )
    count = lambda **params: filter_endpoint(rows, "getMBS", **params).count()
    assert count(year="2023") == 2 and count(series_type="T35,T38", year="2022") == 1
    assert count(table_type="a") == 1 and count(format="json") == 3


def test_filter_reaches_parquet(spark, root):
    spark.range(3).select(F.col("id").cast("string").alias("reporterCode")).write.parquet(root + "/t")
    df = filter_endpoint(spark.read.parquet(root + "/t"), "preview", reporterCode="1,2")
    assert "PushedFilters: [In(reporterCode, [1,2])]" in df._jdf.queryExecution().toString()
