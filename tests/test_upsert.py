from pathlib import Path

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from ferrygate.operators.silver import guard_of, incremental
from ferrygate.operators import upsert as upserts
from ferrygate.operators.upsert import DuplicateSourceKeys, read_silver, upsert
from ferrygate.schemas import REPORTER_SUMMARY, REPORTER_SUMMARY_KEY
from ferrygate.sources.bronze import SchemaConflict


def rows(spark, *triples):
    """(period, freq, reporter code or None, total)"""
    data = [(p, f, c, "ISO", "n", 0.0, 0.0, v, 0.0, 1, 1) for p, f, c, v in triples]
    return spark.createDataFrame(data, REPORTER_SUMMARY)


def load(spark, path, *triples, **kw):
    return upsert(rows(spark, *triples), path, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY, **kw)


def content(spark, path):
    got = read_silver(spark, path, REPORTER_SUMMARY)
    return {
        (r["period"], r["freq_code"], r["reporter_code"]): r["total_trade_value_usd"]
        for r in got.collect()
    }


def test_update_insert_no_delete(spark, root):
    path = root + "/t"
    assert read_silver(spark, path, REPORTER_SUMMARY) is None
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0), ("2023", "A", 2, 2.0))
    touched = load(spark, path, ("2023", "A", 2, 20.0), ("2024", "A", 1, 4.0))
    assert touched == ["2023", "2024"]
    assert content(spark, path) == {
        ("2022", "A", 1): 1.0, ("2023", "A", 1): 1.0, ("2023", "A", 2): 20.0, ("2024", "A", 1): 4.0,
    }


def test_null_keys_match(spark, root):
    path = root + "/t"
    load(spark, path, ("2023", "A", None, 1.0))
    load(spark, path, ("2023", "A", None, 5.0))
    load(spark, path, ("2023", None, None, 7.0))
    assert content(spark, path) == {("2023", "A", None): 5.0, ("2023", None, None): 7.0}


def test_untouched_periods_keep_their_files(spark, root):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0))
    files = lambda: set(spark.read.format("binaryFile").option("recursiveFileLookup", True)
                        .option("pathGlobFilter", "*.parquet").load(path + "/period=2022")
                        .select("path").toPandas()["path"])
    before = files()
    load(spark, path, ("2023", "A", 1, 9.0))
    assert files() == before


def test_duplicate_source_keys(spark, root):
    with pytest.raises(DuplicateSourceKeys):
        load(spark, root + "/t", ("2023", "A", 1, 1.0), ("2023", "A", 1, 2.0))
    with pytest.raises(DuplicateSourceKeys):
        load(spark, root + "/t", ("2023", "A", None, 1.0), ("2023", "A", None, 2.0))


def test_changed_schema(spark, root):
    path = root + "/t"
    load(spark, path, ("2023", "A", 1, 1.0))
    changed = rows(spark, ("2023", "A", 1, 1.0)).withColumn("extra", F.lit(1))
    with pytest.raises(SchemaConflict):
        upsert(changed, path, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY)
    other = rows(spark, ("2023", "A", 1, 1.0)).withColumn("partner_count", F.lit("x"))
    with pytest.raises(SchemaConflict):
        upsert(other, path, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY)


def test_stored_schema_is_checked(spark, root):
    path = root + "/t"
    rows(spark, ("2023", "A", 1, 1.0)).drop("partner_count").write.partitionBy("period").parquet(path)
    with pytest.raises(SchemaConflict):
        load(spark, path, ("2023", "A", 1, 1.0))


def test_full_replaces_everything(spark, root):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0))
    load(spark, path, ("2023", "A", 2, 2.0), full=True)
    assert content(spark, path) == {("2023", "A", 2): 2.0}


def test_empty_source_changes_nothing(spark, root):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0))
    empty = spark.createDataFrame([], REPORTER_SUMMARY)
    assert upsert(empty, path, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY) == []
    assert len(content(spark, path)) == 1


def periods(df):
    return sorted(r["period"] for r in df.collect())


def test_guard(spark):
    target = rows(spark, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0), ("202301", "M", 1, 1.0))
    new = spark.createDataFrame(
        [("2022", "A"), ("2023", "A"), ("2024", "A"), ("202212", "M"), ("202301", "M"),
         ("2020", "Q"), ("2019", None)],
        "period string, freq_code string",
    )
    guard = guard_of(target)
    assert guard == {"A": "2023", "M": "202301"}
    assert periods(incremental(new, guard, "per_freq")) == ["2019", "2020", "2023", "202301", "2024"]
    common = guard_of(target, "reference")
    assert common == {None: "202301"}
    # One monthly load hides the annual rows of the same year from the common guard.
    assert periods(incremental(new, common, "reference")) == ["202301", "2024"]
    assert guard_of(None) == {}
    assert len(periods(incremental(new, {}, "per_freq"))) == 7
    with pytest.raises(ValueError):
        guard_of(target, "other")


def test_only_touched_partitions_are_read(spark, root):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0))
    plan = incremental(read_silver(spark, path, REPORTER_SUMMARY), {"A": "2023"}, "per_freq")
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters" in text
    assert as_dicts(plan)[0]["period"] == "2023"


def changed(spark, path, *triples):
    return upserts.merge(rows(spark, *triples), path, REPORTER_SUMMARY_KEY, REPORTER_SUMMARY).rewritten


def stamps(root):
    return {str(f): f.stat().st_mtime_ns for f in Path(root, "t").rglob("*.parquet") if "period=" in str(f)}


def test_the_same_upsert_twice_touches_no_folder(spark, root):
    path, triples = root + "/t", [("2022", "A", 1, 1.0), ("2023", "A", None, 1.0), (None, "A", 2, 2.0), ("2023", "M", 3, float("nan"))]
    load(spark, path, *triples)
    before = stamps(root)
    assert changed(spark, path, *triples) == [] and stamps(root) == before
    # a part of a period's rows, equal to the table's
    assert changed(spark, path, ("2023", "A", None, 1.0)) == [] and stamps(root) == before
    assert changed(spark, path, ("2023", "A", None, 1.5), ("2022", "A", 1, 1.0)) == ["2023"]


def test_fingerprints_follow_the_table(spark, root):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0), ("2023", "A", 2, 2.0))
    load(spark, path, ("2023", "A", 2, 20.0), ("2023", "A", None, 3.0), ("2024", "A", 1, 4.0))
    load(spark, path, ("2022", "A", 1, 7.0), ("2023", "A", 1, 1.0))
    table = read_silver(spark, path, REPORTER_SUMMARY)
    assert upserts.stored_fingerprints(spark, path) == upserts.fingerprints(table)
    upserts.forget_fingerprints(spark, path)
    assert changed(spark, path, ("2022", "A", 1, 7.0)) == []
    assert changed(spark, path, ("2022", "A", 1, 8.0)) == ["2022"]
    assert upserts.stored_fingerprints(spark, path) == upserts.fingerprints(read_silver(spark, path, REPORTER_SUMMARY).filter("period = '2022'"))


def test_a_write_cut_short_leaves_no_wrong_fingerprint(spark, root, monkeypatch):
    path = root + "/t"
    load(spark, path, ("2022", "A", 1, 1.0), ("2023", "A", 1, 1.0))
    with monkeypatch.context() as patch:
        patch.setattr(upserts, "merged_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, path, ("2023", "A", 1, 2.0))
    assert set(upserts.stored_fingerprints(spark, path)) == {"2022"}
    assert changed(spark, path, ("2023", "A", 1, 2.0)) == ["2023"]
    assert content(spark, path)["2023", "A", 1] == 2.0
