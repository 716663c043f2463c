"""Prefix trie of conversations as minimal-perfect-hash node tables.

Every prefix of a conversation has a 128-bit digest chained over its turns (role and text), so equal prefixes are equal
digests and a node is a digest. Conversations are dealt into shards by a hash of their id, and a shard holds whole paths. A shard enumerates the
distinct digests of its paths, gives each a slot by a minimal perfect hash, checks that every row meets its own digest in its
slot (two digests under one 64-bit key are hashed anew with another seed), and scatters counts, smallest members and parent slots into
flat arrays. The shards' tables meet in one aggregate by digest, where a first turn that a third of all conversations
share is one row per shard.

Sums over subtrees: each node gives its value to one shard that holds it, where all its ancestors stand too. That shard scatters the
values into its slots and adds them up through the parent slots, deepest nodes first. Sums of shards add up by digest.

A path is cut every ``CUT`` turns, so a conversation of any length is many bounded pieces: digests are chained within a
piece and across pieces by their ends, and sums that leave a piece at its top go on in the piece before, one round per cut of
the longest conversation.

Members that end at a node are sorted in ranges, joined into long pieces there, and only the pieces of a node stream through one
task, as SHA-256 needs.

Defined cases: a null role or text is empty; rows without a conversation id belong to no conversation; rows of one turn are ordered by
role and digest of the text; repeated rows are turns of their own; extra columns are ignored; an empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import table, word_count
from .mph import MinimalPerfectHash, mixed
from .ordered import batches_of, digest_of_pieces, in_ranges, rows_of
from .sql import crc32

#: Turns of a shard, turns of a piece of a path, and members whose ids are joined in one piece.
SHARD_TURNS, CUT, ENDS = 200_000, 10_000, 4000
HEADS, EVERY = 4, 20
ROOT = hashlib.sha256().digest()[:16]


# ---- paths


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv, pos, token, words)``: the turns of each conversation, numbered from 1; ``token`` is a digest of role and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("i", pa.int64()), ("token", pa.binary()), ("words", pa.int64())])

        def walk() -> Iterator[tuple]:
            current, i = None, 0
            for conv, _, role, digest, words in rows_of(batches):
                current, i = conv, (i + 1 if conv == current else 1)
                name = role.encode("utf-8", "replace")
                yield conv, part, i, hashlib.sha256(b"%d:%s%s" % (len(name), name, digest.encode())).digest()[:16], words

        yield from batches_of(walk(), schema)

    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.sha2(text, 256).alias("digest"),
        word_count(text).alias("words"),
    )
    walked = in_ranges(narrow, "conv", "turn", "role", "digest").mapInArrow(run, "conv long, part int, i long, token binary, words long")
    walked = materialize(walked, "trie-turns")
    counts = walked.groupBy("conv", "part").agg(F.count("*").alias("n"))
    # only what a conversation has in later ranges moves: at most one row per range
    offsets = counts.select("conv", "part", (F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")).alias("offset"))
    moved = walked.join(offsets.filter("offset > 0"), ["conv", "part"], "left")
    return moved.select("conv", (F.col("i") + F.coalesce("offset", F.lit(0))).alias("pos"), "token", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, convs)``: every conversation begins with the first turns of the one at the last multiple of ``EVERY``.

    How many of its own first turns it gives up for them is its checksum modulo ``HEADS``.
    """
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = turns.filter((F.col("conv") % EVERY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "base")
    given = heads.groupBy("base").agg(F.max("pos").alias("given"))
    lost = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("lost")
    convs = lengths.select("conv", "own", lost, (F.col("conv") - F.col("conv") % EVERY).alias("base")).join(given, "base", "left")
    taken = F.least("lost", F.coalesce("given", F.lit(0).cast("long")))
    convs = convs.select("conv", "base", "lost", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("lost"), F.lit(0))).alias("length"))
    convs = materialize(convs, "trie-conversations")
    own = turns.join(convs.drop("base"), "conv").filter("pos > lost")
    own = own.select("conv", (F.col("pos") - F.col("lost") + F.col("taken")).alias("pos"), "token", "words", "length")
    first = heads.join(convs.filter("taken > 0"), "base").filter("pos <= lost").select("conv", "pos", "token", "words", "length")
    return first.unionByName(own), convs


def paths(rows: DataFrame, cut: int = CUT) -> DataFrame:
    """``(conv, piece, pos, digest, parent, words, last)`` of ``rows(conv, pos, token, words, length)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv", pa.int64()),
                ("piece", pa.int64()),
                ("pos", pa.int64()),
                ("chain", pa.binary()),
                ("chain_before", pa.binary()),
                ("words", pa.int64()),
                ("last", pa.bool_()),
            ]
        )

        def walk() -> Iterator[tuple]:
            at, chain = None, None
            for conv, piece, pos, token, words, length in rows_of(batches):
                if (conv, piece) != at:
                    at, chain = (conv, piece), None
                before, chain = chain, hashlib.sha256((chain or b"") + token).digest()[:16]
                yield conv, piece, pos, chain, before, words, pos == length

        yield from batches_of(walk(), schema)

    pieced = rows.select("conv", F.floor((F.col("pos") - 1) / cut).alias("piece"), "pos", "token", "words", "length")
    chained = (
        pieced.repartition("conv", "piece")
        .sortWithinPartitions("conv", "piece", "pos")
        .mapInArrow(run, "conv long, piece long, pos long, chain binary, chain_before binary, words long, last boolean")
    )
    chained = materialize(chained, "trie-chains")
    tops = _tops(chained.filter(F.col("pos") % cut == 0))
    # a piece's top is the digest of the last prefix before it
    joined = chained.join(tops, ["conv", "piece"], "left").withColumn("top", F.coalesce("top", F.lit(ROOT)))
    digest = _digest("chain")
    return joined.select(
        "conv",
        "piece",
        "pos",
        digest.alias("digest"),
        F.when(F.col("chain_before").isNull(), F.col("top")).otherwise(_digest("chain_before")).alias("parent"),
        "words",
        "last",
    )


def _digest(chain: str):
    return F.unhex(F.substring(F.sha2(F.concat("top", chain), 256), 1, 32))


def _tops(ends: DataFrame) -> DataFrame:
    """``(conv, piece, top)`` of the pieces after the first, from the chains at the end of the full pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walk() -> Iterator[tuple]:
            current, top = None, ROOT
            for conv, piece, chain in rows_of(batches):
                if conv != current:
                    current, top = conv, ROOT
                top = hashlib.sha256(top + chain).digest()[:16]
                yield conv, piece + 1, top

        yield from batches_of(walk(), pa.schema([("conv", pa.int64()), ("piece", pa.int64()), ("top", pa.binary())]))

    streamed = ends.select("conv", "piece", "chain").repartition("conv").sortWithinPartitions("conv", "piece")
    return streamed.mapInArrow(run, "conv long, piece long, top binary")


# ---- shards


def _halves(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)


class NodeTable:
    """Slots of a shard's distinct digests."""

    def __init__(self, digests: np.ndarray, seeds: int = 50):
        for seed in range(seeds):
            self.seed = seed
            keys = self._keys(digests)
            self.hashing = MinimalPerfectHash.build(np.unique(keys))
            self.stored = np.zeros((self.hashing.n, 2), np.uint64)
            slots = self.hashing.slots(keys)
            self.stored[slots] = digests
            if (self.stored[slots] == digests).all():
                self.row_slots = slots
                return
        raise ValueError("no seed keeps the digests apart")

    def _keys(self, digests: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(digests[:, 0], self.seed) + digests[:, 1]

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of every digest, -1 where the shard does not hold it."""
        found = self.hashing.slots(self._keys(digests))
        there = found >= 0
        there[there] = (self.stored[found[there]] == digests[there]).all(axis=1)
        return np.where(there, found, -1)


NODES = "piece long, shard long, slot long, digest binary, parent binary, parent_slot long, depth long, words long, n_convs long, conv long"


def _node_table(rows: pd.DataFrame) -> pd.DataFrame:
    """The flat arrays of a shard, one row per slot."""
    nodes = NodeTable(_halves(rows["digest"]))
    slots, n = nodes.row_slots, nodes.hashing.n
    counts = np.bincount(slots, minlength=n)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, slots, rows["conv"].to_numpy(np.int64))
    one = np.zeros(n, np.int64)
    one[slots] = np.arange(len(rows))  # any row of a slot: what is read from it is equal in all
    return pd.DataFrame(
        {
            "piece": rows["piece"].iloc[0],
            "shard": rows["shard"].iloc[0],
            "slot": np.arange(n),
            "digest": rows["digest"].to_numpy()[one],
            "parent": rows["parent"].to_numpy()[one],
            "parent_slot": nodes.slots(_halves(rows["parent"].iloc[one])),
            "depth": rows["pos"].to_numpy()[one],
            "words": rows["words"].to_numpy()[one],
            "n_convs": counts,
            "conv": smallest,
        }
    )


def _accumulate(nodes: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
    """Sums of ``values`` over the subtrees of a shard's nodes; what leaves at the top goes to the parent's digest."""
    n = len(nodes)
    sums = np.zeros((n, 2), np.int64)
    np.add.at(sums, values["slot"].to_numpy(np.int64), values[["n_leaves", "saved"]].to_numpy(np.int64))
    by_slot = nodes.sort_values("slot")
    parents, depths = by_slot["parent_slot"].to_numpy(np.int64), by_slot["depth"].to_numpy(np.int64)
    order = np.argsort(-depths, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1) if n else []:
        inside = level[parents[level] >= 0]
        np.add.at(sums, parents[inside], sums[inside])
    digests, tops = by_slot["digest"].to_numpy(), parents < 0
    found = pd.DataFrame({"digest": digests, "n_leaves": sums[:, 0], "saved": sums[:, 1], "leaves_shard": False})
    above = pd.DataFrame(
        {"digest": by_slot["parent"].to_numpy()[tops], "n_leaves": sums[tops, 0], "saved": sums[tops, 1], "leaves_shard": True}
    ).groupby("digest", as_index=False).agg({"n_leaves": "sum", "saved": "sum", "leaves_shard": "max"})
    out = pd.concat([found, above[found.columns]])
    return out[(out["n_leaves"] != 0) | (out["saved"] != 0)]


SUMS = "digest binary, n_leaves long, saved long, leaves_shard boolean"


def prefix_trie(rows: DataFrame, convs: DataFrame, cut: int = CUT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``rows(conv, pos, token, words, length)``; ``convs(conv, length)`` has the conversations without turns too."""
    steps = materialize(paths(rows, cut), "trie-paths")
    size = steps.agg(F.count("*").alias("n"), F.max("piece").alias("cuts")).first()
    shards = max(1, -(-size["n"] // shard_turns))
    dealt = steps.select("*", F.pmod(F.xxhash64("conv"), F.lit(shards)).alias("shard"))
    tables = materialize(dealt.groupBy("piece", "shard").applyInPandas(_node_table, NODES), "trie-tables")

    home = F.shiftleft(F.col("shard"), 32).bitwiseOR(F.col("slot"))
    nodes = tables.groupBy("digest", "parent", "depth", "words").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv_id"), F.min(home).alias("home")
    )
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("digest"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
                       F.lit(0).cast("long").alias("words"), "n_convs", "conv_id", F.lit(None).cast("long").alias("home"))
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "digest")
    nodes = nodes.unionByName(root).join(children, "digest", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = materialize(nodes, "trie-nodes")

    place = [F.floor((F.col("depth") - 1) / cut).alias("piece"), F.shiftright("home", 32).alias("shard"), F.col("home").bitwiseAND(0xFFFFFFFF).alias("slot")]
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    values = nodes.filter("depth > 0").select(*place, leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    structure = tables.select("piece", "shard", "slot", "digest", "parent", "parent_slot", "depth")
    sums = []
    for _ in range((size["cuts"] or 0) + 1):
        found = structure.groupBy("piece", "shard").cogroup(values.groupBy("piece", "shard")).applyInPandas(_accumulate, SUMS)
        found = materialize(found, "trie-sums")
        sums.append(found)
        on = found.filter("leaves_shard").groupBy("digest").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        values = on.join(nodes.filter("depth > 0").select("digest", "depth", "home"), "digest").select(*place, "n_leaves", "saved")
    total = sums[0].filter(~F.col("leaves_shard") | (F.col("digest") == F.lit(ROOT)))
    for found in sums[1:]:
        total = total.unionByName(found.filter(~F.col("leaves_shard") | (F.col("digest") == F.lit(ROOT))))
    total = total.groupBy("digest").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))

    ending = steps.filter("last").select(F.hex("digest").alias("node"), "conv")
    ending = ending.unionByName(convs.filter("length = 0").select(F.lit(ROOT.hex().upper()).alias("node"), "conv"))
    ends = digest_of_pieces(_joined_ids(ending), "node", ["first"], "ids", ",").select(F.unhex("node").alias("digest"), F.col("digest").alias("ends"))
    above = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(total, "digest", "left")
        .join(ends, "digest", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.coalesce("n_leaves", F.lit(0))).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def _joined_ids(ending: DataFrame) -> DataFrame:
    """``(node, first, ids)``: the ids that end at a node in ascending order, joined in pieces of at most ``ENDS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walk() -> Iterator[tuple]:
            node, held = None, []
            for at, conv in rows_of(batches):
                if held and (at != node or len(held) >= ENDS):
                    yield node, held[0], ",".join(map(str, held))
                    held = []
                node = at
                held.append(conv)
            if held:
                yield node, held[0], ",".join(map(str, held))

        schema = pa.schema([("node", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
        yield from batches_of(walk(), schema, size=lambda row: len(row[2]))

    return in_ranges(ending, "node", "conv").mapInArrow(run, "node string, first long, ids string")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    turns = materialize(numbered(table(spark, sf_dir, "conversations")), "trie-numbered")
    return prefix_trie(*rebuilt(turns))


OP13_SQL = rf"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, sha256(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c - c % {EVERY} AS base, c::VARCHAR AS decimal FROM turns),
convs AS (SELECT c, base, {crc32('decimal')} % {HEADS} AS lost FROM ids),
heads AS (SELECT v.c, t.pos, t.role, t.digest, t.words FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.lost),
taken AS (SELECT c, count(*) AS n FROM heads GROUP BY c),
rows_ AS (
  SELECT * FROM heads
  UNION ALL
  SELECT t.c, t.pos - v.lost + coalesce(k.n, 0), t.role, t.digest, t.words
  FROM turns t JOIN convs v ON v.c = t.c LEFT JOIN taken k ON k.c = t.c WHERE t.pos > v.lost),
prefixes AS (
  SELECT c, pos AS depth, words,
    sha256(string_agg(length(role) || ':' || role || digest, '/') OVER (PARTITION BY c ORDER BY pos)) AS node
  FROM rows_
  UNION ALL
  SELECT c, 0, 0, 'root' FROM convs),
members AS (
  SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY c) AS last FROM prefixes),
nodes AS (
  SELECT node, any_value(depth)::BIGINT AS depth, any_value(parent) AS parent, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.node = n.node),
-- a node's ancestors are the prefixes of its smallest member
below AS (
  SELECT m.node, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((w.n_convs - 1) * w.words)::BIGINT AS saved_tokens
  FROM counted w JOIN members m ON m.c = w.conv_id AND m.depth <= w.depth GROUP BY m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON b.node = n.node LEFT JOIN nodes p ON p.node = n.parent
"""
