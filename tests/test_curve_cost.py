"""Cuts of the curve are found by halving, and only where a folder needs several files."""

import random

from pyspark.sql import functions as F

from ferrygate.operators import maintenance


def rows(spark):
    return spark.range(40).select(F.col("id").cast("string").alias("code"), F.lit("p").alias("_leaf"), F.col("id").alias("_place"))


def test_a_folder_of_one_file_needs_no_cuts(spark):
    plan = lambda files: maintenance._spread(rows(spark), {"p": files}, ["code"])._jdf.queryExecution().toString()
    assert "_bounds" not in plan(1) and "_bounds" in plan(2)


def test_halving_counts_like_a_scan(spark):
    cuts = sorted(random.Random(3).choices(range(100), k=maintenance.CUTS - 1))
    found = spark.range(-1, 102).select(
        "id",
        maintenance._cuts_below(cuts[:63], F.col("id")).alias("below"),
        F.array(*map(F.lit, cuts)).alias("_bounds"),
    )
    found = found.withColumns(
        {"low": maintenance._bounds_passed(lambda b: b < F.col("id")), "high": maintenance._bounds_passed(lambda b: b <= F.col("id"))}
    )
    for r in found.collect():
        assert r["below"] == sum(c < r["id"] for c in cuts[:63])
        assert (r["low"], r["high"]) == (sum(c < r["id"] for c in cuts), sum(c <= r["id"] for c in cuts))
