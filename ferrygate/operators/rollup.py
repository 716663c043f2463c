"""Reporter summary kept up to date from mergeable state (A2, L2): a late load never makes a period be read again.

State below ``<root>``, written per load and never updated in place:

* ``sums``: per load, period, reporter and flow the exact parts of the value (see ``functions.numeric``) as integers.
* ``sets``: per load, period and reporter the distinct commodities and partners as bitmaps, one row per bucket of 32,768 numbers.
* ``codes``: the number of every commodity code ever seen. Partner codes are numbers already.
* ``pending``: the periods of a load that is being taken in, until their summary is written.

A load has one folder, replaced as a whole when it comes again, so nothing stays of periods that it no longer has. Its rows are
ordered by period: a read of some periods skips row groups by their statistics. The summary of the touched periods is then the merge
of their states: sums add up, bitmaps are joined by or, and both are exact in any order. The state of a period is as
large as its reporters times its loads, however many rows these had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..filesystem import exists, remove_folder
from ..functions.numeric import PARTS, sum_parts, total
from ..schemas import REPORTER_SUMMARY
from ..session import materialize, release
from ..sources.bronze import LOAD_ID, load_folder
from ..sources.layout import partition_folder
from .silver import REPORTER_DIMENSIONS
from .staging import valid_measures
from .upsert import forget_fingerprints

SETS = ("commodity", "partner")
#: The flows that have a column of their own; all others are in the total alone.
FLOWS = {"X": "x", "M": "m"}

_DIMS = [REPORTER_SUMMARY[name] for name in REPORTER_DIMENSIONS]
_LOAD = [StructField(LOAD_ID, StringType())]
_PARTS = [StructField(name, DoubleType() if name == "_other" else LongType()) for name in PARTS]
SUMS = StructType([*_DIMS, StructField("flow", StringType()), *_PARTS, *_LOAD])
BITMAPS = StructType(
    [*_DIMS, StructField("what", StringType()), StructField("bucket", LongType()), StructField("bits", BinaryType()), *_LOAD]
)
PENDING = StructType([StructField("period", StringType()), *_LOAD])
CODES = StructType([StructField("code", StringType()), StructField("number", LongType())])
#: Numbers given out by one task stand apart from those of the next.
TASK_BITS = 33


def _table(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    path = f"{root}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _replace(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", "period")
        .sortWithinPartitions("period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_ID)
        .parquet(path)
    )


# ---- state of a load


def number_codes(spark: SparkSession, root: str, codes: DataFrame) -> DataFrame:
    """``(code, number)`` of all codes known below ``root`` after those of ``codes(code)`` have one.

    New codes are numbered where they lie: each task counts on from a start of its own, so nothing is sorted in one place and
    the numbers of a task are neighbours in a bitmap. A number once given never changes. Loads of one table take
    turns, as its writers have to anyway.
    """
    known = _table(spark, root, "codes", CODES)
    new = codes.filter("code is not null").distinct().join(known, "code", "left_anti")
    newest = known.agg(F.max("number")).first()[0]
    start = 0 if newest is None else ((newest >> TASK_BITS) + 1) << TASK_BITS
    numbered = new.select("code", (F.monotonically_increasing_id() + F.lit(start)).alias("number"))
    numbered.write.mode("append").parquet(f"{root}/codes")
    return spark.read.schema(CODES).parquet(f"{root}/codes")


def load_sums(staged: DataFrame) -> DataFrame:
    """The exact parts of the value per reporter and flow; flows without a column of their own are one."""
    flow = F.when(F.col("flow_code").isin(*FLOWS), F.col("flow_code")).otherwise("").alias("flow")
    parts = sum_parts(F.col("trade_value_usd"))
    return (
        valid_measures(staged)
        .groupBy(*REPORTER_DIMENSIONS, flow)
        .agg(*(F.sum(part).alias(name) for part, name in zip(parts, PARTS)))
    )


def load_sets(staged: DataFrame, numbers: DataFrame) -> DataFrame:
    """Distinct commodities and partners per reporter as bitmaps by bucket."""
    distinct = valid_measures(staged).select(*REPORTER_DIMENSIONS, "commodity_code", "partner_code").distinct()
    coded = distinct.join(numbers, distinct["commodity_code"] == numbers["code"], "left")
    values = F.array(
        F.struct(F.lit("commodity").alias("what"), F.col("number").alias("n")),
        F.struct(F.lit("partner").alias("what"), F.col("partner_code").cast("long").alias("n")),
    )
    tall = coded.select(*REPORTER_DIMENSIONS, F.explode(values).alias("v")).filter("v.n is not null")
    return tall.groupBy(*REPORTER_DIMENSIONS, F.col("v.what").alias("what"), F.bitmap_bucket_number("v.n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v.n")).alias("bits")
    )


# ---- merging


def merged_sets(sets: DataFrame) -> DataFrame:
    return sets.groupBy(*REPORTER_DIMENSIONS, "what", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def summary_of(sums: DataFrame, sets: DataFrame) -> DataFrame:
    """The reporter summary that states of any loads add up to."""

    def summed(name: str, flow: str | None = None) -> list[Column]:
        picked = (F.when(F.col("flow") == flow, F.col(part)) if flow else F.col(part) for part in PARTS)
        return [F.sum(part).alias(f"{name}{part_name}") for part, part_name in zip(picked, PARTS)]

    values = sums.groupBy(*REPORTER_DIMENSIONS).agg(*summed("x", "X"), *summed("m", "M"), *summed("t"))
    counts = merged_sets(sets).groupBy(*REPORTER_DIMENSIONS).agg(
        *(F.sum(F.when(F.col("what") == what, F.bitmap_count("bits"))).alias(f"{what}_count") for what in SETS)
    )
    same = [values[name].eqNullSafe(counts[name]) for name in REPORTER_DIMENSIONS]
    part = lambda name: [F.col(f"{name}{p}") for p in PARTS]
    zero = F.lit(0)
    balance = total(*(F.coalesce(x, zero) - F.coalesce(m, zero) for x, m in zip(part("x"), part("m"))))
    kinds = {field.name: field.dataType for field in REPORTER_SUMMARY.fields}
    return values.join(counts, same, "left").select(
        *(values[name] for name in REPORTER_DIMENSIONS),
        F.coalesce(total(*part("x")), F.lit(0.0)).alias("export_value_usd"),
        F.coalesce(total(*part("m")), F.lit(0.0)).alias("import_value_usd"),
        total(*part("t")).alias("total_trade_value_usd"),
        balance.alias("trade_balance_usd"),
        *(F.coalesce(f"{w}_count", zero).cast(kinds[f"{w}_count"]).alias(f"{w}_count") for w in SETS),
    )


def _in(periods: list[str | None]) -> Column:
    inside = F.col("period").isin(*[p for p in periods if p is not None])
    return inside | F.col("period").isNull() if None in periods else inside


def update_summary(staged: DataFrame, state_root: str, summary_path: str, load_id: str) -> list[str | None]:
    """Take the staged rows of one load into the state and renew the summary of the periods they touch.

    Reads the rows of the load, the codes, and the state of the touched periods; earlier rows are not needed any more.
    Returns the touched periods: those of the load, and those it had before if it is repeated. A call that was cut short
    can be repeated: the periods it had in hand are noted before anything is replaced.
    """
    spark = staged.sparkSession
    load = spark.range(1).select(load_folder(load_id)).first()[0]
    narrow = [*REPORTER_DIMENSIONS, "flow_code", "commodity_code", "partner_code", "trade_value_usd"]
    rows = materialize(staged.select(*narrow), "load-rows")  # read for its codes, sums and sets
    sums = materialize(load_sums(rows), "load-sums")
    numbers = number_codes(spark, state_root, rows.select(F.col("commodity_code").alias("code")))
    mine = F.col(LOAD_ID) == load
    noted = _table(spark, state_root, "pending", PENDING).filter(mine)
    periods = _periods(sums) | _periods(_table(spark, state_root, "sums", SUMS).filter(mine)) | _periods(noted)
    touched = sorted(periods, key=lambda p: (p is None, p or ""))
    if touched:
        pending = f"{state_root}/pending/{partition_folder(spark, {LOAD_ID: load})}"
        spark.createDataFrame([(p,) for p in touched], "period string").coalesce(1).write.mode("overwrite").parquet(pending)
        for name, state in (("sums", sums), ("sets", load_sets(rows, numbers))):
            _take_in(state, f"{state_root}/{name}", load)
        renew_summary(spark, state_root, summary_path, touched)
        remove_folder(spark, pending)
    release(rows, sums)
    return touched


def _take_in(state: DataFrame, path: str, load: str) -> None:
    """Make ``state`` all that the table at ``path`` has of ``load``."""
    state = materialize(state, "load-state")
    spark = state.sparkSession
    if state.isEmpty():  # an empty result overwrites no folder
        remove_folder(spark, f"{path}/{partition_folder(spark, {LOAD_ID: load})}")
    else:
        _replace(state.withColumn(LOAD_ID, F.lit(load)), path)
    release(state)


def _periods(rows: DataFrame) -> set[str | None]:
    return {r["period"] for r in rows.select("period").distinct().collect()}


def renew_summary(spark: SparkSession, state_root: str, summary_path: str, periods: list[str | None]) -> None:
    """Replace the summary of ``periods`` by what their states add up to."""
    sums, sets = (_table(spark, state_root, n, s).filter(_in(periods)) for n, s in (("sums", SUMS), ("sets", BITMAPS)))
    summary = materialize(summary_of(sums, sets).select(*REPORTER_SUMMARY.names), "renewed")
    forget_fingerprints(spark, summary_path)
    (
        summary.hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period")
        .parquet(summary_path)
    )
    for period in set(periods) - _periods(summary):
        remove_folder(spark, f"{summary_path}/{partition_folder(spark, {'period': period})}")
    release(summary)
