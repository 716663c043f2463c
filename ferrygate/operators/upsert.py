"""Upsert on a natural grain into a Parquet table partitioned by period.

Beside the table lies one fingerprint per period: the number of rows, and xor and sum of two hashes of them. It does not depend on
the order of rows, and it changes by what a merge changes, so it is kept up without reading a period again. A source period with the
stored fingerprint is what the table holds and is not even read. In the other periods, source rows that equal the table's
rewrite nothing. Fingerprints of periods that are about to be rewritten are taken away first: one that is there is true.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..filesystem import exists, remove_folder
from ..sources.bronze import SchemaConflict

PARTITION = "period"
FINGERPRINTS = "_fingerprints"
_FINGERPRINT = "period string, n long, xored long, summed decimal(38,0)"

#: Rows, xor of the first hash, sum of the second.
Fingerprint = tuple[int, int, Decimal]


class DuplicateSourceKeys(ValueError):
    """Two source rows claim the same target row."""


def read_silver(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table with its declared types (``period`` stays text); ``None`` before first use."""
    if not exists(spark, path):
        return None
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def check_columns(found: StructType, declared: StructType) -> None:
    """Same columns and types in any order, or :class:`SchemaConflict`."""
    have = {field.name: field.dataType.simpleString() for field in found.fields}
    want = {field.name: field.dataType.simpleString() for field in declared.fields}
    if have != want:
        changed = sorted(set(have.items()) ^ set(want.items()))
        raise SchemaConflict(f"columns differ from the table: {changed}")


def periods_of(source: DataFrame, keys: tuple[str, ...]) -> list[str | None]:
    """Distinct periods of a source whose keys are unique; as many as the table has folders.

    Raises :class:`DuplicateSourceKeys` where a key comes twice.
    """
    counted = source.groupBy(*keys).count()
    rows = counted.groupBy(PARTITION).agg(F.max("count").alias("most")).collect()
    if any(row["most"] > 1 for row in rows):
        repeated = counted.filter("count > 1").limit(5).collect()
        sample = [tuple(row[key] for key in keys) for row in repeated]
        raise DuplicateSourceKeys(f"source keys are not unique, for example {sample}")
    return sorted((row[PARTITION] for row in rows), key=lambda p: (p is None, p or ""))


def merged_rows(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Target rows without a source match, then all source rows. Null keys match null keys."""
    same = reduce(
        lambda a, b: a & b, (target[key].eqNullSafe(source[key]) for key in keys)
    )
    return target.join(source, same, "left_anti").unionByName(source)


def _write(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


# ---- fingerprints


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; a null counts as a value of its own, wherever it stands."""
    values = [*map(F.col, columns), *(F.col(name).isNull() for name in columns)]
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def fingerprints(rows: DataFrame) -> dict[str | None, Fingerprint]:
    """The fingerprint of every period of ``rows``; as many as the table has folders."""
    first, second = row_hashes(sorted(rows.columns))
    found = rows.groupBy(PARTITION).agg(
        F.count("*").alias("n"), F.bit_xor(first).alias("xored"), F.sum(second.cast("decimal(38,0)")).alias("summed")
    )
    return {r[PARTITION]: (r["n"], r["xored"], r["summed"]) for r in found.collect()}


def stored_fingerprints(spark: SparkSession, path: str) -> dict[str | None, Fingerprint]:
    if not exists(spark, f"{path}/{FINGERPRINTS}"):
        return {}
    rows = spark.read.schema(_FINGERPRINT).parquet(f"{path}/{FINGERPRINTS}").collect()
    return {r["period"]: (r["n"], r["xored"], r["summed"]) for r in rows}


def _store_fingerprints(spark: SparkSession, path: str, found: dict[str | None, Fingerprint]) -> None:
    rows = spark.createDataFrame([(p, *f) for p, f in found.items()], _FINGERPRINT)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{FINGERPRINTS}")


def forget_fingerprints(spark: SparkSession, path: str) -> None:
    """For writers that change the table by other means."""
    remove_folder(spark, f"{path}/{FINGERPRINTS}")


def _changes(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> dict[str | None, Fingerprint]:
    """By how much each period's fingerprint changes; periods in which nothing does are left out."""
    first, second = row_hashes(sorted(source.columns))
    hashed = lambda rows, name: rows.select(*(F.col(k).alias(f"{name}_{k}") for k in keys), first.alias(f"{name}_1"), second.alias(f"{name}_2"))
    new, old = hashed(source, "new"), hashed(target, "old")
    same = reduce(lambda a, b: a & b, (F.col(f"new_{key}").eqNullSafe(F.col(f"old_{key}")) for key in keys))
    pairs = new.join(old, same, "left")
    added = F.col("old_1").isNull()
    changed = pairs.filter(added | (F.col("new_1") != F.col("old_1")) | (F.col("new_2") != F.col("old_2")))
    zero, wide = F.lit(0), "decimal(38,0)"
    found = changed.groupBy(f"new_{PARTITION}").agg(
        F.count_if(added).alias("n"),
        F.bit_xor(F.col("new_1").bitwiseXOR(F.coalesce("old_1", zero))).alias("xored"),
        F.sum((F.col("new_2").cast(wide) - F.coalesce("old_2", zero).cast(wide)).cast(wide)).alias("summed"),
    )
    return {r[0]: (r["n"], r["xored"], r["summed"]) for r in found.collect()}


def _inside(periods: list[str | None]) -> Column:
    inside = F.col(PARTITION).isin(*[p for p in periods if p is not None])
    return inside | F.col(PARTITION).isNull() if None in periods else inside


class Merged(NamedTuple):
    """Periods that the source has, and those of them whose folders were written."""

    touched: list[str | None]
    rewritten: list[str | None]


def upsert(
    source: DataFrame, path: str, keys: tuple[str, ...], schema: StructType, full: bool = False
) -> list[str | None]:
    """:func:`merge`; returns the periods that the source has."""
    return merge(source, path, keys, schema, full).touched


def merge(
    source: DataFrame, path: str, keys: tuple[str, ...], schema: StructType, full: bool = False
) -> Merged:
    """Update matched rows, insert new ones, delete none.

    ``period`` belongs to every key, so only the periods present in ``source`` are read, and only those in which a row is
    new or differs are rewritten. ``source`` is used several times: pass a materialised result. ``full`` replaces
    the whole table. Periods are replaced one folder at a time; a reader may see some of
    them before the others.
    """
    spark = source.sparkSession
    check_columns(source.schema, schema)
    source = source.select(*schema.names)
    touched = periods_of(source, keys)
    incoming = fingerprints(source)
    if full:
        source.hint("rebalance", PARTITION).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(PARTITION).parquet(path)
        _store_fingerprints(spark, path, incoming)
        return Merged(touched, touched)
    target = read_silver(spark, path, schema)
    if target is None:
        _write(source, path)
        _store_fingerprints(spark, path, incoming)
        return Merged(touched, touched)
    _check_stored(spark, path, schema)
    stored = stored_fingerprints(spark, path)
    unknown = [p for p in touched if p not in stored or stored[p] != incoming[p]]
    if not unknown:
        return Merged(touched, [])
    source, target = source.filter(_inside(unknown)), target.filter(_inside(unknown))
    changes = _changes(target, source, keys)
    rewritten = [p for p in unknown if p in changes]
    if not rewritten:
        return Merged(touched, [])
    _store_fingerprints(spark, path, {p: f for p, f in stored.items() if p not in changes})
    _write(merged_rows(target.filter(_inside(rewritten)), source.filter(_inside(rewritten)), keys), path)
    known = {p: _plus(stored[p], changes[p]) for p in rewritten if p in stored}
    if missing := [p for p in rewritten if p not in stored]:
        known |= fingerprints(read_silver(spark, path, schema).filter(_inside(missing)))
    _store_fingerprints(spark, path, stored | known)
    return Merged(touched, rewritten)


def _plus(old: Fingerprint, change: Fingerprint) -> Fingerprint:
    return old[0] + change[0], old[1] ^ change[1], old[2] + change[2]


def _check_stored(spark: SparkSession, path: str, schema: StructType) -> None:
    stored = spark.read.parquet(path).schema
    declared = StructType([f for f in schema.fields if f.name != PARTITION])
    check_columns(StructType([f for f in stored.fields if f.name != PARTITION]), declared)
