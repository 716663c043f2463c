"""Secret scans through an incremental ledger of blobs, in DataFrame operations only.

Every text version is a blob named by the SHA-256 of its content, wherever and however often it occurs. The ledger is an
append-only table of ``(sha, findings)`` whose findings name every rule version that was ever run on the blob, with or
without spans. A scan asks the ledger first, with the distinct digests of the versions it is given and no texts: a left join tells which
rules it lacks for each of them. Only texts of those blobs are then fetched, shuffled and scanned, and appended. Findings are joined
back to every path that holds the blob.

Positions come from splitting: the pieces between matches and the matches themselves give every start and end, in code
points, without user-defined functions.

Hot blobs: copies are combined on the map side before texts are shuffled, and the join back is an equi-join that Spark
splits. Defined cases: a null text counts as empty; repeated rows and null ids are reported as
they come; an empty table gives no rows and an empty ledger batch; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..filesystem import exists
from ..session import materialize, release, scratch_dir
from .common import FILE_KEY, ROW_KEY, table, text_or_empty, with_row_key


class Rule(NamedTuple):
    """A detector: matches of ``pattern`` whose ``group`` has at least ``least`` characters. A change needs a new version."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The three base detectors.
RULES = [
    Rule("assign", 1, r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"(AKIA[A-Z0-9]+)", 1, 20),
    Rule("hex", 1, r"([0-9a-f]{24,})", 1, 24),
]

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"sha binary, findings array<struct<rule:string,version:int,spans:{SPANS}>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """``array<struct<start, end>>`` of the rule's matches, leftmost first, not overlapping."""
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length)
    groups = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state: Column, item: Column) -> Column:
        begin = state["at"] + item["piece"]
        end = begin + item["match"]
        found = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(item["group"] >= rule.least, F.concat(state["spans"], found)).otherwise(state["spans"]).alias("spans"),
        )

    zipped = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), groups.alias("group")),
        lambda x: F.struct(x["piece"].alias("piece"), x["match"].alias("match"), x["group"].alias("group")),
    )
    found = F.aggregate(zipped, start, step, lambda state: state["spans"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(SPANS))


def blob_name(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``(sha, findings)``: all findings of a blob over all batches."""
    rows = spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(ledger)
    return rows.groupBy("sha").agg(F.flatten(F.collect_list("findings")).alias("findings"))


def scan_versions(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """Scan what the ledger lacks for the texts of ``versions(..., text)`` and return the whole ledger.

    The ledger is a folder. Each call appends one batch folder, written as a whole by Spark's committer; a call that
    failed leaves nothing that is read and can be repeated.
    """
    spark = versions.sparkSession
    text = text_or_empty()
    def unseen(rule: Rule) -> Column:
        return ~F.coalesce(F.array_contains("done", f"{rule.kind}:{rule.version}"), F.lit(False))

    lacking, asked = reduce(Column.__or__, map(unseen, rules)), None
    if exists(spark, ledger):
        done = F.transform("findings", lambda f: F.concat_ws(":", f["rule"], f["version"].cast("string"))).alias("done")
        known = read_ledger(spark, ledger).select("sha", done)
        # one row stands for each blob, so texts meet their digests by row and copies of one blob are not brought together
        keyed = with_row_key(versions.select("text"))
        blobs = keyed.groupBy(blob_name(text).alias("sha")).agg(F.min(F.struct(FILE_KEY, ROW_KEY)).alias("row"))
        lacked = blobs.join(known, "sha", "left").filter(lacking).select("sha", "done", "row.*")
        # written, so that its size is known: where little is new, Spark sends it to the texts instead of moving them
        asked = materialize(lacked, "unseen")
        scanned = keyed.join(asked, [FILE_KEY, ROW_KEY]).select("sha", "done", text.alias("text"))
    else:
        blobs = versions.select(blob_name(text).alias("sha"), text.alias("text")).dropDuplicates(["sha"])
        scanned = blobs.withColumn("done", F.lit(None).cast("array<string>"))

    def finding(rule: Rule) -> Column:
        spans = spans_of(F.col("text"), rule).alias("spans")
        return F.when(unseen(rule), F.struct(F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version"), spans))

    findings = F.array_compact(F.array(*map(finding, rules))).alias("findings")
    scanned.select("sha", findings).write.parquet(f"{ledger}/batch-{uuid.uuid4().hex}")
    if asked is not None:
        release(asked)
    return read_ledger(spark, ledger)


def _spans(rule: Rule) -> Column:
    """The ledger's spans of this version of the rule."""
    mine = F.filter("findings", lambda f: (f["rule"] == rule.kind) & (f["version"] == rule.version))
    return F.coalesce(F.try_element_at(mine, F.lit(1))["spans"], F.array().cast(SPANS)).alias(rule.kind)


def report(versions: DataFrame, ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Findings per path: ``versions`` without its text, counts per rule, and all spans ``kind:start:end`` in order."""

    def place(rank: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("span"),
            ),
        )

    placed = [place(rank, rule.kind) for rank, rule in enumerate(rules)]
    spans = F.array_join(F.transform(F.array_sort(F.concat(*placed)), lambda s: s["span"]), ",")
    per_blob = ledger.select("sha", *map(_spans, rules)).select(
        F.col("sha").alias("blob"), *(F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in rules), spans.alias("spans")
    )
    paths = versions.select("doc_id", blob_name(text_or_empty()).alias("sha"))
    # written first: a join of two plain shuffles can be split where one blob has very many paths
    return paths.join(materialize(per_blob, "findings"), F.col("sha") == F.col("blob")).drop("blob")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scanned through a ledger in two arrivals: half of the ids, then all, of which the ledger knows the first half."""
    docs, folder = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_dir(spark, "ledger")
    scan_versions(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), folder)
    ledger = scan_versions(docs, folder)
    return report(docs, ledger).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans"
    )


def _sql_spans(rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT row, '{rule.kind}' AS kind, {RULES.index(rule)} AS rank, piece + before AS start, piece + before + match AS stop
FROM (
  SELECT row, group_length, match,
    sum(piece) OVER (PARTITION BY row ORDER BY i) AS piece,
    sum(match) OVER (PARTITION BY row ORDER BY i) - match AS before
  FROM (
    SELECT row, i, length(pieces[i]) AS piece, length(matches[i]) AS match, length(groups[i]) AS group_length
    FROM (
      SELECT row, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}', 0) AS matches,
        regexp_extract_all(text, '{pattern}', {rule.group}) AS groups
      FROM numbered) split, unnest(range(1, len(matches) + 1)) AS t(i))) placed
WHERE group_length >= {rule.least}"""


OP6_SQL = f"""
WITH numbered AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(map(_sql_spans, RULES))}),
listed AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans
  FROM found GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM numbered LEFT JOIN listed USING (row)
"""
