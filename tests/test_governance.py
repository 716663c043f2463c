import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrygate.operators import scanledger
from ferrygate.operators.governance import luhn_valid, pii_findings

CASES = {
    "mail a.b+c@x.example.com, d@e.org.": {"email": 2},
    "no@tld and @x.com": {},
    "card 4111 1111 1111 1111 and 4111111111111112": {"card": 1},
    "4111111111111111 4111111111111111": {"card": 2},
    "94111111111111111234567": {},
    "at 10.0.0.1. or 256.1.1.1 or 1.2.3 or 1.2.3.4.5": {"ip": 1},
    "call +1 (743) 555-3824 or 555-123-4567 in 2023 555.123.4567": {"phone": 3},
    "date 2024-01-15 10:00": {},
    "": {},
}


@pytest.mark.parametrize("text", CASES)
def test_detectors(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, body string")
    got = {r["kind"]: r["n"] for r in pii_findings(df, "t", "id").collect()}
    assert got == CASES[text]


def test_all_text_columns_and_marking(spark):
    df = spark.createDataFrame([("k", "x@y.org", 5, None), ("l", None, 1, "10.0.0.1")],
                               "key string, a string, n int, b string")
    rows = pii_findings(df, "t", "key").collect()
    assert {(r["row_key"], r["column_name"], r["kind"], r["severity"], r["low"]) for r in rows} == {
        ("k", "a", "email", "Medium", False), ("l", "b", "ip", "Low", True),
    }


def test_one_narrow_pass(spark):
    df = spark.createDataFrame([(1, "x")], "id int, body string")
    plan = pii_findings(df, "t", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_long_repetitive_text(spark):
    body = "1.1." * 50_000 + " " + "1 " * 50_000 + "a" * 100_000 + " x@y.org"
    df = spark.createDataFrame([(1, body)], "id int, body string")
    assert {r["kind"]: r["n"] for r in pii_findings(df, "t", "id").collect()} == {"email": 1}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789", min_size=1, max_size=19), min_size=60, max_size=60))
def test_luhn(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    got = df.select("n", luhn_valid(F.col("n"))).collect()
    assert [r[1] for r in got] == [plain_luhn(r[0]) for r in got]


SCHEMA = "id int, body string"


def put(spark, path, *bodies):
    spark.createDataFrame(list(enumerate(bodies)), SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def stop(*_):
    raise KeyboardInterrupt


def known(spark, root):
    rows = scanledger.known_findings(spark, f"{root}/t", f"{root}/l", "t").collect()
    return sorted((r["row_key"], r["kind"], r["n"]) for r in rows)


def test_second_scan_reads_no_file(spark, root, monkeypatch):
    monkeypatch.setattr(scanledger, "FILES_PER_BATCH", 2)
    for name in ("a {x}", "b", "c%2", "d"):
        put(spark, f"{root}/t/{name}", "x@y.org", "nothing")
    scan = lambda: scanledger.scan_new(spark, f"{root}/t", f"{root}/l", "t", "id", SCHEMA)
    assert scan() == 4 and known(spark, root) == [("0", "email", 1)] * 4
    monkeypatch.setattr(scanledger, "pii_findings", None)  # nothing is left to scan
    assert scan() == 0 and known(spark, root) == [("0", "email", 1)] * 4


def test_replaced_and_removed_files_and_new_detectors(spark, root, monkeypatch):
    scan = lambda: scanledger.scan_new(spark, f"{root}/t", f"{root}/l", "t", "id", SCHEMA)
    put(spark, f"{root}/t/a", "x@y.org")
    put(spark, f"{root}/t/b", "10.0.0.1")
    assert scan() == 2
    put(spark, f"{root}/t/a", "two x@y.org z@y.org")
    assert known(spark, root) == [("0", "ip", 1)]
    assert scan() == 1 and known(spark, root) == [("0", "email", 2), ("0", "ip", 1)]
    monkeypatch.setattr(scanledger, "DETECTORS", 2)
    assert known(spark, root) == [] and scan() == 2
    assert known(spark, root) == [("0", "email", 2), ("0", "ip", 1)]


def test_scan_cut_short_between_findings_and_files(spark, root, monkeypatch):
    scan = lambda: scanledger.scan_new(spark, f"{root}/t", f"{root}/l", "t", "id", SCHEMA)
    put(spark, f"{root}/t/a", "x@y.org")
    with monkeypatch.context() as broken:
        broken.setattr(scanledger, "_remember", stop)
        with pytest.raises(KeyboardInterrupt):
            scan()
    assert spark.read.parquet(f"{root}/l/findings").count() == 1 and known(spark, root) == []
    assert scan() == 1 and known(spark, root) == [("0", "email", 1)]
