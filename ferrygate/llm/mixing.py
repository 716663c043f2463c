"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets an exponential key ``-ln(u) / weight``: ``u`` is a uniform number from a digest of the
seed, the id and the text, so reruns agree, and a larger quality weight gives smaller keys. A source whose target is
``e`` times its size and a rest takes ``e`` complete epochs of all its documents first; the rest is
taken in key order up to the word budget, the document at the border in part.

The order within a source is never sorted in one task: keys fall into about the square root of the
source's row count of buckets, bucket sizes are prefix-summed, and only the rows of one bucket are sorted
together. What one task holds is a bucket, or one row per bucket of a source.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, last in
order; repeated rows are documents of their own; a null id or a document without a label has the default
weight; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import table, text_or_empty, word_count

MAX_EPOCHS = 3
SEED = "mix-1"
#: Weight of a document by its quality label; without one, 1.
QUALITY_WEIGHTS = {0: 0.5, 1: 2.0}
DEFAULT_WEIGHT = 1.0
#: Range of the twelve hex digits that ``u`` is made of, plus one.
HEX_RANGE = 281474976710657.0


def sampling_keys(docs: DataFrame, labels: DataFrame | None, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, key)`` of every document."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty())))
    sized = docs.select(
        "doc_id",
        "source",
        word_count(text_or_empty()).alias("size"),
        ((F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1.0) / HEX_RANGE).alias("u"),
    )
    if labels is not None:
        quality = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        sized = sized.join(quality, "doc_id", "left")
    else:
        sized = sized.withColumn("quality", F.lit(None).cast("int"))
    weight = F.lit(DEFAULT_WEIGHT)
    for value, its in QUALITY_WEIGHTS.items():
        weight = F.when(F.col("quality") == value, its).otherwise(weight)
    return sized.select("doc_id", "source", "size", (-F.ln("u") / weight).alias("key"))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target, n)`` from one row per source with ``source_size`` and row count ``n``.

    Weights are 1, 2, 3, repeating by code point order. A target above ``max_epochs`` times the size stops
    there and the excess is shared again by weight until none is above: the level ``t`` at which the sum of
    ``min(t * weight, cap)`` is the total. The windows run over one row per source.
    """
    ordered = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).select(
        "*",
        ((F.col("rank") - 1) % 3 + 1).cast("double").alias("weight"),
        (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap"),
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    levels = ordered.select(
        "*",
        (
            (F.sum("source_size").over(Window.partitionBy()) - (F.sum("cap").over(by_ratio) - F.col("cap")))
            / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
        ).alias("level"),
    )
    reached = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    return levels.select("*", F.max(reached).over(Window.partitionBy()).alias("reached")).select(
        "source", "source_size", F.least(F.col("reached") * F.col("weight"), F.col("cap")).alias("target"), "n"
    )


def mix(docs: DataFrame, labels: DataFrame | None, seed: str = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, epochs, taken)`` of every document."""
    keyed = materialize(sampling_keys(docs, labels, seed), "mix-keys")
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = (
        source_targets(sizes, max_epochs)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .select(
            F.col("source").alias("its_source"),
            "source_size",
            "target",
            "epochs",
            F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long").alias("budget"),
            F.ceil(F.sqrt("n")).alias("buckets"),
        )
    )
    dealt = keyed.join(targets, F.col("source").eqNullSafe(F.col("its_source"))).select(
        "*", F.floor((1.0 - F.exp(-F.col("key"))) * F.col("buckets")).alias("bucket")
    )
    before = (
        dealt.groupBy(F.col("its_source").alias("b_source"), F.col("bucket").alias("b_bucket"))
        .agg(F.sum("size").alias("bucket_size"))
        .select(
            "b_source",
            "b_bucket",
            (F.sum("bucket_size").over(Window.partitionBy("b_source").orderBy("b_bucket")) - F.col("bucket_size")).alias("before"),
        )
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.select("*", (F.sum("size").over(inside) - F.col("size")).alias("ahead")).join(
        before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))
    )
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("before") - F.col("ahead")))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.col("epochs").cast("long").alias("epochs"),
        (F.col("epochs") * F.col("size") + rest).cast("long").alias("taken"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, weighted by their quality labels."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP7_SQL = f"""
WITH quality AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hashed AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}' || '|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE + 1.0)
      / {HEX_RANGE} AS u
  FROM documents),
keyed AS (
  SELECT h.doc_id, source, size,
    -ln(u) / (CASE quality WHEN 1 THEN {QUALITY_WEIGHTS[1]} WHEN 0 THEN {QUALITY_WEIGHTS[0]} ELSE {DEFAULT_WEIGHT} END)::DOUBLE AS key
  FROM hashed h LEFT JOIN quality q ON h.doc_id = q.doc_id),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM keyed GROUP BY source),
ordered AS (SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, {float(MAX_EPOCHS)}::DOUBLE * source_size AS cap FROM sizes),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - (sum(cap) OVER (ORDER BY cap / weight, rank) - cap))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered),
targets AS (
  SELECT source, source_size,
    least(max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight, cap) AS target
  FROM levels),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS e FROM targets)
SELECT k.doc_id, size, source_size, target,
  (e * size + greatest(0, least(size, round(target - e * source_size)::BIGINT
    - (sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size))))::BIGINT AS taken
FROM keyed k JOIN epochs t ON k.source IS NOT DISTINCT FROM t.source
"""
