import math

import pytest
from pyspark.sql import functions as F

from ferrygate.functions.numeric import growth_pct, half_up
from ferrygate.functions.text import (
    InvalidArgument,
    flow_argument,
    iso_argument,
    limit_argument,
    period_month,
    period_year,
    year_argument,
)
from ferrygate.plans import queries as q
from ferrygate.schemas import REPORTER_SUMMARY, TRADE_FLOWS
from ferrygate.sources.extracts import bi_reporter_summary, bi_trade_flows, refresh_extract


def summary(spark, *rows):
    """(period, freq, iso, exports, imports)"""
    data = [
        (p, f, i, iso, iso and iso.lower(), x, m, x + m if x is not None else None, x - m if x is not None else None, 1, 1)
        for i, (p, f, iso, x, m) in enumerate(rows)
    ]
    return spark.createDataFrame(data, REPORTER_SUMMARY)


@pytest.fixture(scope="module")
def two_years(spark):
    return summary(
        spark,
        ("2022", "A", "AA", 100.0, 50.0), ("2023", "A", "AA", 150.0, 25.0),
        ("2022", "A", "BB", 200.0, 0.0), ("2023", "A", "BB", 100.0, 10.0),
        ("2022", "A", "CC", 0.0, 1.0), ("2023", "A", "CC", 9.0, 1.0),
        ("2022", "A", None, 5.0, 5.0), ("2023", "A", None, 5.0, 5.0),
        ("202301", "M", "AA", 999.0, 0.0),
    )


def test_growth(spark, two_years):
    rows = q.yoy_growth(two_years, "2022", "2023", unit=1.0).collect()
    got = [(r["reporter_iso"], r["export_growth_pct"], r["import_growth_pct"]) for r in rows]
    assert got == [("AA", 50.0, -50.0), ("BB", -50.0, None)]
    assert "export_2023_usd_bn" in rows[0].asDict()


def test_ranking_order_and_ties(spark):
    df = summary(
        spark,
        ("2023", "A", "ZZ", 5.0, 0.0), ("2023", "A", "YY", 5.0, 0.0),
        ("2023", "A", "XX", None, None), ("2023", "A", "WW", 9.0, 0.0), ("2022", "A", "VV", 99.0, 0.0),
    )
    got = [r["country_iso"] for r in q.top_exporters(df, "2023").collect()]
    assert got == ["WW", "YY", "ZZ", "XX"]


def test_freshness_takes_largest_total(spark):
    df = summary(spark, ("2022", "A", "AA", 9.0, 0.0), ("2023", "A", "AA", 3.0, 0.0))
    row = q.data_freshness(df, unit=1.0).first()
    assert (row["latest_period"], row["period_count"], row["latest_total_trade_usd_bn"]) == ("2023", 2, 9.0)


def test_reporters_and_series(two_years):
    assert [r["reporter_iso"] for r in q.list_reporters(two_years, "2023", limit=2).collect()] == ["AA", "BB"]
    assert q.list_reporters(two_years).count() == 8
    got = q.reporter_series(two_years, " aa ").collect()
    assert [r["period"] for r in got] == ["2023", "2022"]
    with pytest.raises(q.NotFound):
        q.reporter_series(two_years, "ZZ", must_exist=True)


@pytest.fixture(scope="module")
def flows(spark):
    def row(period, freq, reporter, partner, commodity, flow, value):
        return (period, freq, "C", 1, reporter, "r", 2, partner, "p", commodity, "c", flow, "f", value, 1)

    return spark.createDataFrame(
        [
            row("2023", "A", "US", "DE", "TOTAL", "X", 10.0), row("2022", "A", "US", "DE", "TOTAL", "M", 7.0),
            row("2022", "A", "US", "DE", "TOTAL", "X", 8.0), row("2022", "A", "US", "DE", "01", "X", 6.0),
            row("202201", "M", "US", "DE", "TOTAL", "X", 1.0), row("2023", "A", "FR", "DE", "01", "X", 11.0),
            row("2023", "A", "FR", "DE", "02", "X", None),
        ],
        TRADE_FLOWS,
    )


def test_bilateral(flows):
    rows = q.bilateral_flows(flows, "US", "DE", unit=1.0).collect()
    assert [(r["period"], r["flow_code"]) for r in rows] == [("2022", "M"), ("2022", "X"), ("2023", "X")]


def test_top_commodities(flows):
    rows = q.top_commodities(flows, "US", "2022", unit=1.0).collect()
    assert [r["trade_value_usd_mn"] for r in rows] == [8.0, 7.0, 6.0]


def test_search(flows):
    assert [r["trade_value_usd"] for r in q.search_flows(flows, limit=3).collect()] == [11.0, 10.0, 8.0]
    assert q.search_flows(flows).collect()[-1]["trade_value_usd"] is None
    assert q.search_flows(flows, reporter_iso="us", partner_iso="de", period="2022", flow_code="x").count() == 2
    assert "flow_name" in q.search_flows(flows).columns


@pytest.mark.parametrize(
    "call, bad",
    [
        (iso_argument, "USAA"), (iso_argument, "U1"), (iso_argument, "US'; --"), (year_argument, "202301"),
        (year_argument, "20x3"), (flow_argument, "Re-Export"), (flow_argument, "1"),
    ],
)
def test_bad_arguments(call, bad):
    with pytest.raises(InvalidArgument):
        call(bad)


def test_good_arguments():
    assert (iso_argument(" usa "), year_argument("2023"), flow_argument("x")) == ("USA", "2023", "X")
    assert limit_argument(None, (20, 200)) == 20 and limit_argument(200, (20, 200)) == 200
    for bad in (0, 201, True, "5"):
        with pytest.raises(InvalidArgument):
            limit_argument(bad, (20, 200))


def test_limits_are_enforced(flows, two_years):
    for call in (
        lambda: q.search_flows(flows, limit=1001),
        lambda: q.reporter_series(two_years, "AA", limit=51),
        lambda: q.list_reporters(two_years, limit=201),
    ):
        with pytest.raises(InvalidArgument):
            call()


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (-0.001, 2, 0.0), (None, 2, None)],
)
def test_half_up(spark, value, digits, expected):
    df = spark.createDataFrame([(value,)], "v double").select(half_up(F.col("v"), digits).alias("r"))
    got = df.first()["r"]
    assert got == expected
    assert got is None or math.copysign(1.0, got) == (1.0 if expected >= 0 else -1.0)


def test_growth_of_zero_base(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "c double, b double")
    assert [r[0] for r in df.select(growth_pct(F.col("c"), F.col("b"))).collect()] == [None, 50.0]


def test_period_parts(spark):
    df = spark.createDataFrame([("2023",), ("202307",)], "p string")
    got = df.select(period_year(F.col("p")), period_month(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("2023", "01"), ("2023", "07")]


def test_extracts(spark, two_years, flows, root):
    extract = bi_reporter_summary(two_years)
    kinds = dict(extract.dtypes)
    assert kinds["export_value_usd"] == "decimal(28,2)" and kinds["commodity_count"] == "int"
    assert extract.count() == 8 and len(extract.columns) == 11
    assert len(bi_trade_flows(flows).columns) == 15
    refresh_extract(extract, root + "/x")
    refresh_extract(extract, root + "/x")
    assert spark.read.parquet(root + "/x").count() == 8


def test_rankings_do_not_sort_globally(two_years, flows):
    for df in (
        q.top_exporters(two_years, "2023"), q.list_reporters(two_years), q.search_flows(flows),
        q.top_commodities(flows, "US", "2022"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
