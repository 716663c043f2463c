import gzip
import json
import os

from conftest import flow
from pyspark.sql import functions as F

from ferrygate.operators.metrics import scan_alarm
from ferrygate.sources.bronze import read_bronze
from ferrygate.sources.deadletter import scan_manifests
from ferrygate.streaming.alarm import start_alarm, stream_alarm
from ferrygate.streaming.landing import start_landing_load


def land(base, run, records):
    folder = base / "raw/preview/type=C/freq=A/year=2024/month=03"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{run}.json").write_text(json.dumps({"data": records}))


def load(spark, base, max_files=10_000):
    query = start_landing_load(
        spark, f"{base}/raw", f"{base}/bronze", f"{base}/state", f"{base}/ckpt", max_files=max_files
    )
    query.awaitTermination()
    return read_bronze(spark, f"{base}/bronze", "preview")


def test_each_file_once(spark, tmp_path):
    land(tmp_path, "a", [flow()])
    land(tmp_path, "bad", [flow(period=None)])
    assert load(spark, tmp_path).count() == 1
    assert load(spark, tmp_path).count() == 1
    land(tmp_path, "b", [flow(cmdCode="1"), flow(cmdCode="2")])
    rows = load(spark, tmp_path).collect()
    assert len(rows) == 3 and len({r["_loaded_at"] for r in rows}) == 2
    letters = scan_manifests(spark, f"{tmp_path}/state/errors").collect()
    assert [r["run_id"] for r in letters] == ["bad"]


def test_several_batches(spark, tmp_path):
    for i in range(3):
        land(tmp_path, f"r{i}", [flow(cmdCode=i)])
    rows = load(spark, tmp_path, max_files=1).collect()
    assert len(rows) == 3 and len({r["load_id"] for r in rows}) == 3


def deliver(base, folder, name, records):
    target = base / "raw/preview" / folder
    target.mkdir(parents=True, exist_ok=True)
    text = json.dumps({"data": records})
    if name.endswith(".gz"):
        (target / name).write_bytes(gzip.compress(text.encode()))
    else:
        (target / name).write_text(text)


def test_one_delivery_in_three_forms_over_two_restarts(spark, tmp_path):
    march, april = "type=C/freq=A/year=2024/month=03", "type=C/freq=A/year=2024/month=04"
    deliver(tmp_path, march, "a.json", [flow(cmdCode="1"), flow(cmdCode="2")])
    deliver(tmp_path, march, "a.json.gz", [flow(cmdCode="1"), flow(cmdCode="2")])
    assert load(spark, tmp_path).count() == 2
    deliver(tmp_path, april, "a.json", [flow(cmdCode="1"), flow(cmdCode="2")])
    assert load(spark, tmp_path).count() == 2
    deliver(tmp_path, april, "a.txt", [flow(cmdCode="1"), flow(cmdCode="2")])
    deliver(tmp_path, april, "b.json", [flow(cmdCode="1"), flow(cmdCode="2")])  # another run with equal content
    deliver(tmp_path, march, "a.txt.gz", [flow(cmdCode="3")])  # the same run with other content
    codes = sorted(r["cmdCode"] for r in load(spark, tmp_path).collect())
    assert codes == ["1", "1", "2", "2", "3"]


def test_old_files_are_never_too_late(spark, tmp_path):
    deliver(tmp_path, "type=C/freq=A/year=2024/month=03", "new.json", [flow(cmdCode="1")])
    assert load(spark, tmp_path).count() == 1
    deliver(tmp_path, "type=C/freq=A/year=2024/month=03", "old.json", [flow(cmdCode="2")])
    os.utime(tmp_path / "raw/preview/type=C/freq=A/year=2024/month=03/old.json", (1e9, 1e9))
    assert load(spark, tmp_path).count() == 2


POINTS = [
    ("2024-01-01 00:00:00", 60.0), ("2024-01-01 00:04:59", 50.0), ("2024-01-01 00:05:00", 100.0),
    ("2024-01-01 00:11:00", 101.0), ("2024-01-01 02:00:00", 1.0),
]


def put(spark, path, rows):
    df = spark.createDataFrame(rows, "t string, value double")
    df.select(F.to_timestamp("t").alias("ts"), "value").coalesce(1).write.mode("append").parquet(path)


def run_alarm(spark, root):
    points = spark.readStream.schema("ts timestamp, value double").parquet(root + "/in")
    start_alarm(stream_alarm(points, 100.0), root + "/out", root + "/ckpt").awaitTermination()
    return {str(r["window_start"]): r["total"] for r in spark.read.parquet(root + "/out").collect()}


def test_alarm_matches_batch_and_drops_late_points(spark, root):
    put(spark, root + "/in", POINTS)
    batch = scan_alarm(spark.read.parquet(root + "/in"), 100.0).collect()
    expected = {"2024-01-01 00:00:00": 110.0, "2024-01-01 00:10:00": 101.0}
    assert {str(r["window_start"]): r["total"] for r in batch} == expected
    assert run_alarm(spark, root) == expected
    # Long after its window closed: not counted, and no window fires twice.
    put(spark, root + "/in", [("2024-01-01 00:06:00", 500.0), ("2024-01-01 04:00:00", 1.0)])
    assert run_alarm(spark, root) == expected


def test_archived_files_leave_the_zone(spark, tmp_path):
    def run():
        start_landing_load(
            spark, f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/state", f"{tmp_path}/ckpt",
            archive=f"{tmp_path}/done",
        ).awaitTermination()

    land(tmp_path, "a", [flow()])
    run()
    land(tmp_path, "b", [flow(cmdCode="1")])
    run()
    land(tmp_path, "c", [flow(cmdCode="2")])
    run()
    assert read_bronze(spark, f"{tmp_path}/bronze", "preview").count() == 3
    assert [p.name for p in (tmp_path / "done").rglob("a.json")] == ["a.json"]
