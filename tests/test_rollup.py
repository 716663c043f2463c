"""The summary from state equals the one from all rows."""

import random

import pytest
from conftest import as_dicts, flow, frame
from pyspark.sql import functions as F

from ferrygate.operators import rollup
from ferrygate.operators.silver import reporter_summary
from ferrygate.operators.staging import stage_preview
from ferrygate.operators.upsert import read_silver
from ferrygate.plans.loads import load_summary
from ferrygate.schemas import REPORTER_SUMMARY
from ferrygate.sources.bronze import append_bronze

NOW = "2024-01-15T06:00:00+00:00"


def records(seed, n=120, periods=("2021", "2022", "2023")):
    rng = random.Random(seed)
    return [
        flow(
            period=rng.choice(periods), reporterCode=str(rng.choice([4, 578, 842])), partnerCode=rng.choice([None, "-7", "0", "40000", str(rng.randrange(50))]),
            cmdCode=rng.choice([None, "TOTAL", f"{rng.randrange(200):04d}"]), flowCode=rng.choice(["X", "M", "Re-Export", None]),
            primaryValue=rng.choice([None, "-1", "0.1", "1e-16", "3e15", str(rng.random() * 1e6)]),
        )
        for _ in range(n)
    ]


def staged(spark, rows):
    return stage_preview(frame(spark, rows))


def update(spark, root, load, rows):
    return rollup.update_summary(staged(spark, rows), f"{root}/state", f"{root}/summary", load)


def stored(spark, root):
    return as_dicts(read_silver(spark, f"{root}/summary", REPORTER_SUMMARY), "period", "freq_code", "reporter_code")


def rebuilt(spark, rows):
    return as_dicts(reporter_summary(staged(spark, rows)), "period", "freq_code", "reporter_code")


def equal(mine, theirs):
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        assert a == {k: pytest.approx(v, rel=1e-14) if isinstance(v, float) else v for k, v in b.items()}


def test_late_loads_add_up(spark, root):
    loads = {name: records(i, 90) for i, name in enumerate("abc")}
    for name, rows in loads.items():
        update(spark, root, name, rows)
    equal(stored(spark, root), rebuilt(spark, sum(loads.values(), [])))


def test_a_repeated_load_replaces_itself_and_leaves_old_periods(spark, root):
    kept, wrong, right = records(1, 60, ("2021", "2022")), records(2, 60, ("2022", "2023", "2024")), records(3, 60, ("2021", "2022"))
    update(spark, root, "a", kept)
    update(spark, root, "b", wrong)
    touched = update(spark, root, "b", right)
    assert touched == ["2021", "2022", "2023", "2024"]
    equal(stored(spark, root), rebuilt(spark, kept + right))
    assert update(spark, root, "b", right) == ["2021", "2022"]


def test_a_call_cut_short_can_be_repeated(spark, root, monkeypatch):
    kept, wrong, right = records(4, 40, ("2021",)), records(5, 40, ("2022",)), records(6, 40, ("2021",))
    update(spark, root, "a", kept)
    update(spark, root, "b", wrong)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    for name in ("renew_summary", "remove_folder"):
        with monkeypatch.context() as patch:
            patch.setattr(rollup, name, stop)
            with pytest.raises(RuntimeError):
                update(spark, root, "b", right)
    update(spark, root, "b", right)
    equal(stored(spark, root), rebuilt(spark, kept + right))


def test_numbers_of_codes_never_change(spark, root):
    code = lambda *names: spark.createDataFrame([(n,) for n in names], "code string")
    first = {r["code"]: r["number"] for r in rollup.number_codes(spark, root, code("a", "b", None, "a")).collect()}
    second = {r["code"]: r["number"] for r in rollup.number_codes(spark, root, code("b", "c", "d")).collect()}
    assert set(first) == {"a", "b"} and set(second) == {"a", "b", "c", "d"}
    assert first.items() <= second.items() and len(set(second.values())) == 4


def test_empty_load_and_odd_names(spark, root):
    update(spark, root, "2024-01-01T00:00:00+00:00", records(7, 30))
    before = stored(spark, root)
    assert update(spark, root, "nothing", []) == []
    assert stored(spark, root) == before


def test_only_the_rows_of_the_load_are_read(spark, root):
    first, late = records(8, 80), records(9, 80)
    append_bronze(frame(spark, first), f"{root}/bronze", "preview", NOW, "first")
    load_summary(spark, f"{root}/bronze", f"{root}/silver", "first")
    append_bronze(frame(spark, late), f"{root}/bronze", "preview", NOW, "late")
    for folder in __import__("pathlib").Path(root, "bronze").rglob("load_id=first"):
        for file in folder.iterdir():
            file.unlink()
    load_summary(spark, f"{root}/bronze", f"{root}/silver", "late")
    found = as_dicts(read_silver(spark, f"{root}/silver/reporter_summary", REPORTER_SUMMARY), "period", "freq_code", "reporter_code")
    equal(found, rebuilt(spark, first + late))


def test_bitmaps_have_one_row_per_bucket(spark, root):
    rows = [flow(partnerCode=str(i), cmdCode=str(i)) for i in range(500)]
    update(spark, root, "a", rows)
    sets = spark.read.parquet(f"{root}/state/sets")
    assert sets.filter(F.col("what") == "partner").count() == 2  # 0 and 1 to 499 lie in two buckets
    assert stored(spark, root)[0]["commodity_count"] == stored(spark, root)[0]["partner_count"] == 500
