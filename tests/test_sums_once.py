"""Sums and their digits are rounded once."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ferrygate.functions import numeric

VALUES = [5.414587759995e20, 9.853158002825e-08, 645283.5600015, 1.0, -2.5, float("inf"), None]


def test_digits_next_to_the_middle_of_two(spark):
    # the first reads back from a text that ends in 5 and is a little less than that
    rows = spark.createDataFrame([(v,) for v in VALUES], "v double")
    got = [r[0] for r in rows.select(numeric.significant(F.col("v"), 12)).collect()]
    assert got == [None if v is None else "%.11e" % v for v in VALUES]
    assert got[0] == "5.41458775999e+20"


@pytest.mark.parametrize("base, copies", [(55952.95, 6), (72453.49, 12), (1234567890123.25, 1), (44262.72, 6)])
def test_decimals_and_what_lies_below_them_are_added_before_rounding(spark, base, copies):
    sums = []
    for k in range(200):
        values = [base / 4] * copies + [6.244567e-08 * (k + 1), 2.091257e-08 * (k + 7), 3.144993e-18]
        sums.append((k, values, float(sum(Decimal(repr(v)) for v in values))))
    rows = spark.createDataFrame([(k, v) for k, values, _ in sums for v in values], "k int, v double")
    got = {r["k"]: r["s"] for r in rows.groupBy("k").agg(numeric.exact_sum(F.col("v")).alias("s")).collect()}
    assert [k for k, _, wanted in sums if got[k] != wanted] == []
