"""What the summary reads, and what the record view exchanges."""

from conftest import SF, as_dicts
from pyspark.sql import functions as F

from ferrygate.fixtures import tables as t
from ferrygate.operators.silver import flows_exact, reporter_summary, summary_from_flows
from ferrygate.operators.staging import stage_preview


def test_distinct_counts_read_added_up_rows(spark):
    staged = stage_preview(t.bronze_preview(spark, SF))
    summary = reporter_summary(staged)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Expand", 1)[1]
    key = ("period", "freq_code", "reporter_code")
    assert as_dicts(summary, *key) == as_dicts(summary_from_flows(flows_exact(staged)), *key)


def test_rows_without_a_measure_or_a_code_are_counted_as_before(spark):
    staged = stage_preview(t.bronze_preview(spark, SF))
    odd = staged.withColumn("commodity_code", F.when(F.col("partner_code") > 3, F.col("commodity_code")))
    odd = odd.withColumn("trade_value_usd", F.when(F.col("reporter_code") != 5, F.col("trade_value_usd")))
    rows = reporter_summary(odd)
    wanted = odd.filter("trade_value_usd >= 0").groupBy("period", "freq_code", "reporter_code").agg(
        F.count_distinct("commodity_code").alias("commodity_count"), F.count_distinct("partner_code").alias("partner_count")
    )
    key = ("period", "freq_code", "reporter_code")
    assert as_dicts(rows.select(*wanted.columns), *key) == as_dicts(wanted, *key)


def test_order_lines_are_exchanged_by_the_key_they_are_joined_on(spark):
    plan = t.bronze_preview(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "hashpartitioning(l_orderkey" in plan
