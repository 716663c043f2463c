"""Nothing is lost: one test for every way in which rows, digits or fields once went missing."""

import gzip
import json
import math
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from conftest import as_dicts, flow, frame
from pyspark.sql import functions as F

from ferrygate.filesystem import file_sizes
from ferrygate.functions.numeric import exact_sum
from ferrygate.operators.maintenance import apply_retention, compact
from ferrygate.plans.loads import backfill, ingest
from ferrygate.sources.bronze import append_bronze, merge_columns, note_columns, read_bronze, stored_columns
from ferrygate.sources.deadletter import manifests, scan_manifests, write_manifests
from ferrygate.sources.envelopes import read_envelopes
from ferrygate.sources.landing import flatten_records

NOW = "2024-01-15T06:00:00+00:00"


def summed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v")).alias("s")).first()["s"]


def test_sums_of_very_small_and_very_large_amounts(spark):
    assert summed(spark, [4e-7] * 1000) == pytest.approx(4e-4, rel=1e-12)
    assert summed(spark, [0.1] * 10) == 1.0
    assert summed(spark, [4e-16] * 1000) == pytest.approx(4e-13, rel=1e-14)
    assert summed(spark, [1e-18] * 1000) == pytest.approx(1e-15, rel=1e-14)
    assert summed(spark, [3.14159265e-10]) == 3.14159265e-10
    assert summed(spark, [2.5e-40, 2.5e-40]) == 5e-40
    assert summed(spark, [1.0, 1e-14]) == pytest.approx(math.fsum([1.0, 1e-14]), rel=1e-15)
    assert summed(spark, [1e19, 5.0, None]) == 1e19 + 5
    assert summed(spark, [math.inf, 1.0]) == math.inf
    assert summed(spark, [-2.5, 2.25, -0.0]) == -0.25
    assert summed(spark, [None]) is None


def test_sums_above_the_largest_integer(spark):
    many = spark.range(12_000_000).select(F.lit(9e11).alias("v"))
    assert many.agg(exact_sum(F.col("v")).alias("s")).first()["s"] == 12e6 * 9e11
    assert many.agg(exact_sum(-F.col("v")).alias("s")).first()["s"] == -12e6 * 9e11


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e14, max_value=1e14), min_size=1, max_size=30))
def test_sums_equal_exact_ones(spark, values):
    assert summed(spark, values) == pytest.approx(math.fsum(values), rel=1e-12, abs=max(map(abs, values)) * 1e-14)


def test_a_narrower_backfill_keeps_a_wider_one(spark, root):
    rows = frame(spark, [flow(period="2020", reporterCode=str(c)) for c in (1, 2, 3)])
    for more in ({}, {"reporter_code": "3"}, {"reporter_code": "3"}):
        backfill(rows, {"endpoint": "preview", "periods": ["2020"], **more}, f"{root}/b", NOW)
    found = [r["reporterCode"] for r in read_bronze(spark, f"{root}/b", "preview").collect()]
    assert sorted(found) == ["1", "2", "3", "3"]


def test_a_backfill_asks_for_one_classification(spark, root):
    rows = frame(spark, [flow(period="2020", cmdCode=i) for i in range(3)])
    rows = rows.withColumn("_extra", F.when(F.col("cmdCode") == "1", F.create_map(F.lit("clCode"), F.lit("SITC"))))
    status = backfill(rows, {"endpoint": "preview", "periods": ["2020"]}, f"{root}/b", NOW)
    assert status.first()["rows"] == 2


def test_retention_keeps_what_has_no_readable_stamp(spark, root):
    stamps = [None, "soon", "2023-01-01T00:00:00+00:00", "2024-01-14T00:00:00+00:00"]
    rows = spark.createDataFrame([("d", "t", str(i), s, s) for i, s in enumerate(stamps)], "dag_id string, task_id string, run_id string, failed_at string, execution_date string")
    rows = manifests(rows, NOW).withColumn("failed_at", F.when(F.col("run_id") != "0", F.col("failed_at")))
    write_manifests(rows, f"{root}/e", NOW, "load")
    assert apply_retention(spark, f"{root}/e", NOW) == 1
    assert sorted(r["run_id"] for r in scan_manifests(spark, f"{root}/e").collect()) == ["0", "1", "3"]


def test_field_names_that_look_like_types(spark):
    records = [{"VOID_CODE": "1", "isVARIANT": None, "OBJECT": {"VOID": 1, "a b:c,d": [{"x": 1.5}]}}, {"n": 2}]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "t string")
    rows = [r.asDict(recursive=True) for r in flatten_records(df, "t").collect()]
    assert rows[0]["VOID_CODE"] == "1" and rows[0]["OBJECT.VOID"] == 1 and rows[1]["n"] == 2
    assert rows[0]["OBJECT.a b:c,d"] == [{"x": 1.5}] or float(rows[0]["OBJECT.a b:c,d"][0]["x"]) == 1.5


def test_columns_added_at_once_are_all_kept(spark, root):
    append_bronze(frame(spark, [flow()]), root, "preview", NOW, "a")
    path = f"{root}/preview"
    stored = stored_columns(spark, path)
    for name in ("one", "second"):
        extra = frame(spark, [flow()]).withColumn(name, F.lit("x")).select(name).schema
        note_columns(spark, path, merge_columns(stored, extra))
    assert {"one", "second"} <= set(stored_columns(spark, path).names)


def put(path, text, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if zipped else text.encode())


def test_paths_with_blanks_pluses_and_zipped_files(spark, tmp_path):
    base = tmp_path / "raw zone"
    text = json.dumps({"data": [flow()]})
    put(base / "preview/type=C/year=2023/month=01/2024-01-01T00+00.json", text)
    put(base / "preview/type=C/year=2023/month=01/zipped.json.gz", text, zipped=True)
    rows = as_dicts(read_envelopes(spark, str(base)), "run_id")
    assert [(r["endpoint"], r["run_id"], len(r["records"])) for r in rows] == [
        ("preview", "2024-01-01T00+00", 1), ("preview", "zipped", 1),
    ]


def test_a_file_outside_every_endpoint_stops_an_ingest(spark, tmp_path):
    put(tmp_path / "raw/stray.json", json.dumps({"data": [flow()]}))
    with pytest.raises(ValueError, match="endpoint"):
        ingest(read_envelopes(spark, f"{tmp_path}/raw"), f"{tmp_path}/b", f"{tmp_path}/s", NOW)


def test_bare_words_are_read_as_text(spark, tmp_path):
    put(tmp_path / "raw/preview/a.json", '{"data": [{"period": "2020", "x": NaN, "y": [-Infinity , 1], "z": "a, NaN"}]}')
    row = read_envelopes(spark, f"{tmp_path}/raw").first()
    assert row["records"][0]["x"] == "NaN" and row["records"][0]["z"] == "a, NaN"


def test_an_empty_period_is_not_null(spark, root):
    rows = frame(spark, [flow(period=p, cmdCode=i) for i, p in enumerate(["", None, "2020"])])
    append_bronze(rows, root, "preview", NOW, "a")
    found = read_bronze(spark, root, "preview")
    assert sorted((r["cmdCode"], r["period"]) for r in found.collect()) == [("0", ""), ("1", None), ("2", "2020")]
    assert found.filter("period = '2020'").count() == 1


def test_compaction_merges_loads_and_a_repeated_load_replaces_its_rows(spark, root):
    for i in range(6):
        append_bronze(frame(spark, [flow(period=p, cmdCode=i) for p in ("2020", "2021")]), root, "preview", NOW, f"load-{i}")
    path = f"{root}/preview"
    assert file_sizes(spark, path).count() == 12
    assert compact(spark, path) == ["2020", "2021"]
    assert file_sizes(spark, path).count() == 2
    codes = lambda: sorted((r["period"], r["cmdCode"]) for r in read_bronze(spark, root, "preview").collect())
    assert codes() == sorted((p, str(i)) for i in range(6) for p in ("2020", "2021"))
    append_bronze(frame(spark, [flow(period="2020", cmdCode="new")]), root, "preview", NOW, "load-3")
    assert codes() == sorted([(p, str(i)) for i in range(6) for p in ("2020", "2021") if i != 3] + [("2020", "new")])
    compact(spark, path)
    assert len(codes()) == 11


def test_a_repeated_ingest_leaves_the_same_state(spark, tmp_path):
    base = tmp_path / "raw/preview/type=C/freq=A/year=2023/month=01"
    put(base / "good.json", json.dumps({"data": [flow()]}))
    ingest(read_envelopes(spark, f"{tmp_path}/raw"), f"{tmp_path}/b", f"{tmp_path}/s", NOW, "first")
    put(base / "good.json", json.dumps({"data": [flow(newField="1")]}))
    put(base / "bad.json", json.dumps({"data": [flow(period=None)]}))
    state = []
    for _ in range(2):
        report = ingest(read_envelopes(spark, f"{tmp_path}/raw"), f"{tmp_path}/b", f"{tmp_path}/s", NOW, "second")
        tables = {p: spark.read.parquet(f"{tmp_path}/s/{p}").count() for p in ("metrics", "drift", "columns_baseline")}
        tables["errors"] = scan_manifests(spark, f"{tmp_path}/s/errors").count()
        tables["bronze"] = read_bronze(spark, f"{tmp_path}/b", "preview").count()
        tables["changes"] = report.drift.count()
        state.append(tables)
    assert state[0] == state[1]
    assert state[0]["errors"] == 1 and state[0]["drift"] == 1 and state[0]["bronze"] == 2
    assert Path(f"{tmp_path}/s/drift").exists()
