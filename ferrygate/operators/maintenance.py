"""Small-file compaction and manifest retention (L3, L4)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..filesystem import exists, file_sizes, remove_folder
from ..sources.bronze import (
    COMPACTED,
    LOAD_ID,
    SOURCE_LOAD,
    mark_merging,
    merge_columns,
    note_columns,
    stored_columns,
    table_path,
    unmark_merging,
)
from ..sources.deadletter import LOAD, PARTITIONS, scan_manifests
from ..sources.layout import NULL_FOLDER, decoded, partition_folder

log = logging.getLogger(__name__)

TARGET_FILE_BYTES = 256 * 1024 * 1024
ROW_GROUP_BYTES = 32 * 1024 * 1024
#: Columns that reads look single values up in, in lower case, and how many distinct values their bloom filters expect.
CLUSTER = ("reportercode", "partnercode", "cmdcode")
BLOOM_VALUES = 10_000
#: Shares that each of them is cut into, as a power of two, and shares of a folder's rows along the curve.
CURVE_BITS, CUTS = 6, 128
FILES_PER_JOB = 10_000

FOLDERS = (*PARTITIONS, LOAD)

# Fixed value: age limit of manifests in days.
RETENTION_DAYS = 90


class MaintenanceError(Exception):
    """Some tables of a maintenance run failed."""


def _leaf(partitions: list[str]) -> Column:
    """Name of a row's partition folder. Built from partition columns only, so it prunes."""
    if not partitions:
        return F.lit("")
    return F.concat_ws("/", *(F.coalesce(F.col(p), F.lit(NULL_FOLDER)) for p in partitions))


def crowded_leaves(
    spark: SparkSession, path: str, partitions: list[str], target_bytes: int
) -> DataFrame:
    """``leaf, files, bytes, wanted`` of the folders of ``partitions`` that hold more files than they need."""
    files = file_sizes(spark, path).select(
        *(
            decoded(F.regexp_extract("path", f"/{name}=([^/]*)/", 1)).alias(name)
            for name in partitions
        ),
        "length",
    )
    sizes = files.groupBy(_leaf(partitions).alias("leaf")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
    wanted = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("int")
    return sizes.withColumn("wanted", wanted).filter(F.col("files") > F.col("wanted"))


def _jobs(leaves: dict[str, int]) -> Iterator[dict[str, int]]:
    """Folders in groups of a bounded number of output files."""
    group: dict[str, int] = {}
    for leaf, wanted in leaves.items():
        if group and sum(group.values()) + wanted > FILES_PER_JOB:
            yield group
            group = {}
        group[leaf] = wanted
    if group:
        yield group


def compact(
    spark: SparkSession,
    path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    cluster: tuple[str, ...] = CLUSTER,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> list[str]:
    """Merge the loads of crowded periods into one folder with files near the target size.

    Rows do not change: those of all loads of a period go to the folder ``load_id=compacted``, each with the load it
    came from, so that a load that is repeated later can still replace its rows (see ``append_bronze``). The merged
    folders are removed afterwards. While that is under way a mark lies beside the data: readers then leave out what is there twice, so a
    compaction that was cut short shows no row twice, and the next one finishes its work.

    Rows are ordered along a space-filling curve over the ``cluster`` columns the table has, and these get bloom filters: a
    read of one reporter, partner or commodity skips the row groups without it. A period's rows are spread over as many
    tasks as it needs files, in the curve's order; what shares a place on the curve is spread by its place in the old files, which a
    repeated task sees again. Returns the periods rewritten.
    """
    columns = stored_columns(spark, path)
    if columns is None:
        raise FileNotFoundError(path)
    keys = ["period"] if "period" in columns.names else []
    found = crowded_leaves(spark, path, keys, target_bytes).collect()
    leaves = {row["leaf"]: row["wanted"] for row in found}
    loads = LOAD_ID in columns.names
    if leaves and loads:
        note_columns(spark, path, merge_columns(columns, StructType.fromDDL(f"{SOURCE_LOAD} string")))
    named = [c for c in columns.names if c.lower() in cluster and c not in keys]
    for group in _jobs(leaves):
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        rows = spark.read.schema(stored_columns(spark, path)).parquet(path).withColumn("_place", place)
        rows = rows.withColumn("_leaf", _leaf(keys)).filter(F.col("_leaf").isin(*group))
        old = []
        if loads:
            rows, old = _merged(rows, keys)
            mark_merging(spark, path, [row["period"] for row in old] if keys else [])
        writer = (
            _spread(rows, group, named)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("parquet.block.size", row_group_bytes)
            .partitionBy(*keys, *([LOAD_ID] if loads else []))
        )
        for name in named:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", BLOOM_VALUES)
        writer.parquet(path)
        for row in old:
            remove_folder(spark, f"{path.rstrip('/')}/{partition_folder(spark, row, (*keys, LOAD_ID))}")
        if loads:
            unmark_merging(spark, path)
    return sorted(leaves)


def _spread(rows: DataFrame, wanted: dict[str, int], cluster: list[str]) -> DataFrame:
    """``rows`` with ``_leaf`` and ``_place``, dealt into the wanted number of files per leaf in the order of the curve."""
    spark = rows.sparkSession
    rows = rows.withColumn("_curve", curve(rows, cluster))
    starts = accumulate([0, *wanted.values()])
    leaves = spark.createDataFrame([(*x, n) for x, n in zip(wanted.items(), starts)], "_leaf string, _wanted int, _start int")
    slot, large = F.lit(0), [leaf for leaf, files in wanted.items() if files > 1]
    if large:  # a folder of one file needs no cuts
        cuts = [i / CUTS for i in range(1, CUTS)]
        bounds = rows.filter(F.col("_leaf").isin(large)).groupBy("_leaf").agg(F.percentile_approx("_curve", cuts, 1000).alias("_bounds"))
        leaves = leaves.join(bounds, "_leaf", "left")
        low, high = _bounds_passed(lambda b: b < F.col("_curve")), _bounds_passed(lambda b: b <= F.col("_curve"))
        # a place that many rows share lies between several bounds, and its rows are dealt to all of them
        even = F.pmod("_place", F.lit(1_000_003)) / F.lit(1_000_003.0)
        dealt = F.least(F.floor((low + even * (high - low + 1)) * F.col("_wanted") / CUTS), F.col("_wanted") - 1)
        slot = F.when(F.col("_wanted") > 1, dealt).otherwise(0)
    return (
        rows.join(leaves, "_leaf")
        .withColumn("_slot", (F.col("_start") + slot).cast("int"))
        .repartitionById(sum(wanted.values()), "_slot")
        .sortWithinPartitions("_curve")
        .drop("_slot", "_leaf", "_wanted", "_start", "_bounds", "_curve", "_place")
    )


def _bounds_passed(passed: Callable[[Column], Column]) -> Column:
    """How many of the ``CUTS`` - 1 ascending bounds a row has passed, by halving."""
    steps = F.array(*(F.lit(CUTS >> i) for i in range(1, CUTS.bit_length())))
    step = lambda at, by: at + F.when(passed(F.element_at("_bounds", at + by)), by).otherwise(0)
    return F.aggregate(steps, F.lit(0), step)


def curve(rows: DataFrame, columns: list[str]) -> Column:
    """The place of a row on a Z-order curve over text columns, each cut into equal shares of the rows.

    The cuts are approximate quantiles of the first seven bytes, found in one aggregate; a few numbers per column reach the driver.
    """
    if not columns:
        return F.lit(0).cast("long")
    numbers = [_leading_bytes(F.col(name).cast("string")) for name in columns]
    shares = [i / (1 << CURVE_BITS) for i in range(1, 1 << CURVE_BITS)]
    cuts = rows.agg(*(F.percentile_approx(number, shares, 1000).alias(f"c{i}") for i, number in enumerate(numbers))).first()
    place = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        known = cuts[f"c{i}"] or []  # equal cuts stay: they keep the shares even
        bucket = _cuts_below(known, number)
        for bit in range(CURVE_BITS):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
    return place


def _cuts_below(cuts: list[int], number: Column) -> Column:
    def below(part: list[int], n: Column) -> Column:
        if not part:
            return F.lit(0)
        half = len(part) // 2
        return F.when(n > part[half], below(part[half + 1 :], n) + (half + 1)).otherwise(below(part[:half], n))

    # the lambda's variable stands for the number, which is worked out once
    return F.element_at(F.transform(F.array(number), lambda n: below(cuts, n)), 1)


def _leading_bytes(text: Column) -> Column:
    """The first seven bytes as a number that orders like the text; null comes first."""
    digits = F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(-1).cast("long"))


def _merged(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, list]:
    """All rows under the common load folder, those of earlier compactions once, and the folders they replace."""
    merged = rows.filter(F.col(LOAD_ID) == COMPACTED)
    loads = rows.filter(F.col(LOAD_ID) != COMPACTED)
    there = merged.select("_leaf", SOURCE_LOAD).distinct()
    fresh = loads.withColumn(SOURCE_LOAD, F.col(LOAD_ID)).join(there, ["_leaf", SOURCE_LOAD], "left_anti")
    both = merged.unionByName(fresh).withColumn(LOAD_ID, F.lit(COMPACTED))
    return both, loads.select(*keys, LOAD_ID).distinct().collect()


def maintain(
    spark: SparkSession, root: str, tables: list[str], target_bytes: int = TARGET_FILE_BYTES
) -> dict[str, list[str]]:
    """Compact every table of a list; failures are gathered and raised once at the end."""
    done: dict[str, list[str]] = {}
    failures: list[str] = []
    for table in tables:
        try:
            done[table] = compact(spark, table_path(root, table), target_bytes)
        except Exception as error:
            log.exception("compaction of %s failed", table)
            failures.append(f"{table}: {error}")
    if failures:
        raise MaintenanceError(f"{len(failures)} table(s) failed: " + "; ".join(failures))
    return done


def is_expired(now: str, days: int = RETENTION_DAYS) -> Column:
    """Older than ``days`` at ``now`` (ISO-8601 text); what has no readable stamp is kept."""
    age = F.unix_micros(F.to_timestamp(F.lit(now))) - F.unix_micros(F.try_to_timestamp("failed_at"))
    return F.coalesce(age > days * 86_400_000_000, F.lit(False))


def retained(manifests: DataFrame, now: str, days: int = RETENTION_DAYS) -> DataFrame:
    return manifests.filter(~is_expired(now, days))


def apply_retention(
    spark: SparkSession, path: str, now: str, days: int = RETENTION_DAYS
) -> int:
    """Delete expired manifests; returns how many. Folders without expired rows are not touched."""
    if not exists(spark, path):
        return 0
    rows = scan_manifests(spark, path, with_load=True)
    per_folder = (
        rows.groupBy(*FOLDERS)
        .agg(F.count_if(is_expired(now, days)).alias("gone"), F.count("*").alias("n"))
        .filter("gone > 0")
        .collect()
    )
    partly = [row for row in per_folder if row["gone"] < row["n"]]
    if partly:
        wanted = [
            "/".join(NULL_FOLDER if row[p] is None else row[p] for p in FOLDERS)
            for row in partly
        ]
        (
            retained(rows.filter(_leaf(list(FOLDERS)).isin(*wanted)), now, days)
            .hint("rebalance", *FOLDERS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*FOLDERS)
            .json(path)
        )
    for row in per_folder:
        if row["gone"] == row["n"]:
            remove_folder(spark, f"{path.rstrip('/')}/{partition_folder(spark, row, FOLDERS)}")
    return sum(row["gone"] for row in per_folder)
