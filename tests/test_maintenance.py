from pathlib import Path

import pytest
from conftest import flow, frame
from pyspark.sql import functions as F

from ferrygate.filesystem import exists, file_sizes
from ferrygate.operators.maintenance import MaintenanceError, apply_retention, compact, maintain
from ferrygate.sources.bronze import append_bronze, read_bronze
from ferrygate.sources.deadletter import manifests, scan_manifests, write_manifests

T = "2024-01-01T00:00:00+00:00"


def scattered(spark, path, schema_of=None):
    rows = frame(spark, [flow(period=str(2020 + i % 3), cmdCode=i) for i in range(60)])
    rows.repartition(6).write.partitionBy("period").parquet(path)


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_compaction_keeps_rows(spark, root):
    path = root + "/t"
    scattered(spark, path)
    before = content(spark.read.parquet(path))
    assert file_sizes(spark, path).count() > 10
    assert compact(spark, path) == ["2020", "2021", "2022"]
    assert file_sizes(spark, path).count() == 3
    assert content(spark.read.parquet(path)) == before
    assert compact(spark, path) == []


def test_large_folder_is_written_by_several_tasks(spark, root):
    path = root + "/t"
    rows = frame(spark, [flow(cmdCode=i * 7919) for i in range(4000)])
    rows.repartition(40).write.partitionBy("period").parquet(path)
    before = content(spark.read.parquet(path))
    total = file_sizes(spark, path).agg(F.sum("length")).first()[0]
    assert compact(spark, path, target_bytes=total // 6) == ["2023"]
    assert 2 <= file_sizes(spark, path).count() < 40
    assert content(spark.read.parquet(path)) == before


def test_bronze_tables_and_null_period(spark, root):
    for load in ("a", "b"):
        rows = frame(spark, [flow(), flow(period=None)])
        append_bronze(rows, root, "preview", T, load)
        rows.selectExpr("*", f"'{T}' as _loaded_at", f"'{load}' as load_id").write.mode(
            "append").partitionBy("period", "load_id").parquet(f"{root}/preview")
    before = content(read_bronze(spark, root, "preview"))
    assert len(maintain(spark, root, ["preview"])["preview"]) == 2
    assert content(read_bronze(spark, root, "preview")) == before
    assert len(before) == 8


def test_failures_are_gathered(spark, root):
    scattered(spark, root + "/good")
    with pytest.raises(MaintenanceError, match="2 table") as caught:
        maintain(spark, root, ["missing1", "good", "missing2"])
    assert "missing1" in str(caught.value) and "missing2" in str(caught.value)
    assert file_sizes(spark, root + "/good").count() == 3


def test_retention(spark, root):
    now = "2024-06-30T00:00:00+00:00"
    rows = spark.createDataFrame(
        [
            ("d", "t", "89 days", "2024-04-02T00:00:00+00:00", "2024-04-02"),
            ("d", "t", "90 days", "2024-04-01T00:00:00+00:00", "2024-04-01"),
            ("d", "t", "91 days", "2024-03-31T00:00:00+00:00", "2024-04-01"),
            ("d", "old", "all gone", "2023-01-01T00:00:00+00:00", "2023-01-01"),
            ("d", "new", "kept", "2024-06-29T00:00:00+00:00", "2024-06-29"),
        ],
        "dag_id string, task_id string, run_id string, failed_at string, execution_date string",
    )
    path = root + "/errors"
    assert apply_retention(spark, path, now) == 0
    write_manifests(manifests(rows, now), path, now)
    assert apply_retention(spark, path, now) == 2
    assert {r["run_id"] for r in scan_manifests(spark, path).collect()} == {"89 days", "90 days", "kept"}
    assert not list(Path(f"{path}/dag_id=d/task_id=old/year=2023/month=01").glob("*/*.json"))
    assert apply_retention(spark, path, now) == 0
