"""Exact deduplication against immutable snapshots, screened by static binary-fuse filters.

Texts are equal when they are the same bytes after deleting space, tab, line feed, vertical tab, form feed and
carriage return. A row is known by the SHA-256, the MD5 and the byte length of that normalised text; all three are compared
wherever this module says that bytes are checked, so that no text has to be shuffled.

A snapshot is written once and never changed: its groups (one row per distinct text) and, per shard of digests, a
3-wise binary-fuse filter with one-byte fingerprints (about nine bits per text). A new batch is first grouped
by itself. Each of its distinct texts asks its shard's filter: what is surely new stays a group of the batch; what may be known joins
the snapshot's groups on the whole digest, where about 0.4 % false positives fall out.

Hot groups: rows of equal texts are combined before any shuffle, and shards hold distinct texts only, so a copy that
makes up a third of all rows is one entry. The join back to all rows is an equi-join that Spark splits.

Defined cases: a null text counts as empty, and all empty texts are one group; of fully equal rows (id and text)
the first in file order stays; a null id loses against any id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_dir
from .common import FILE_KEY, ROW_KEY, table, with_row_key

#: Distinct texts per filter shard, on average.
SHARD_KEYS = 50_000
#: Deleted before texts are compared.
DELETED = b"\x20\x09\x0a\x0b\x0c\x0d"
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

DIGESTS = f"doc_id long, n_chars int, sha binary, md5 binary, n_bytes long, {FILE_KEY} long, {ROW_KEY} long"
KEY = ["sha", "md5", "n_bytes"]
FILTERS = "shard long, seed long, segment int, segments int, prints binary"


# ---- the filter, plain numpy over the keys of one shard


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * _MIX_1
    h = (h ^ (h >> np.uint64(33))) * _MIX_2
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots of each hash, in three consecutive segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = first.astype(np.int64) * segment
    mask = np.uint64(segment - 1)
    within = [(h & mask), ((h >> np.uint64(16)) & mask), ((h * _MIX_1) >> np.uint64(40)) & mask]
    return np.stack([base + i * segment + w.astype(np.int64) for i, w in enumerate(within)], axis=1)


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """``(seed, segment length, start segments, fingerprints)`` for distinct 64-bit keys."""
    n = max(1, len(keys))
    segment = 1 << min(16, max(2, int(np.log(n) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for seed in range(1, 200):
        segments = max(1, int(np.ceil(n * factor / segment)) - 2 + seed // 20)
        h = _mixed(keys, seed)
        slots = _slots(h, segment, segments)
        order = _peel(slots, (segments + 2) * segment)
        if order is not None:
            prints = np.zeros((segments + 2) * segment, np.uint8)
            wanted = _fingerprint(h)
            for key, slot in reversed(order):
                a, b, c = slots[key]
                prints[slot] = wanted[key] ^ prints[a] ^ prints[b] ^ prints[c]
            return seed, segment, segments, prints.tobytes()
    raise ValueError("no seed places the keys; are they distinct?")


def _peel(slots: np.ndarray, size: int) -> list[tuple[int, int]] | None:
    """Keys in the order in which each has a slot of its own, or None where that fails."""
    count = np.bincount(slots.ravel(), minlength=size)
    which = np.zeros(size, np.int64)
    for column in slots.T:
        np.bitwise_xor.at(which, column, np.arange(len(slots)))
    count, which, rows = count.tolist(), which.tolist(), slots.tolist()
    ready = [s for s, c in enumerate(count) if c == 1]
    order = []
    while ready:
        slot = ready.pop()
        if count[slot] != 1:
            continue
        key = which[slot]
        order.append((key, slot))
        for s in rows[key]:
            count[s] -= 1
            which[s] ^= key
            if count[s] == 1:
                ready.append(s)
    return order if len(order) == len(rows) else None


def may_contain(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    table_ = np.frombuffer(prints, np.uint8)
    h = _mixed(keys, seed)
    slots = _slots(h, segment, segments)
    return _fingerprint(h) == (table_[slots[:, 0]] ^ table_[slots[:, 1]] ^ table_[slots[:, 2]])


# ---- digests, snapshots, batches


def digests(keyed: DataFrame) -> DataFrame:
    """Digests of the normalised text of every row of ``with_row_key(docs)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            sha, md5, n_bytes, n_chars = [], [], [], []
            for value in texts:
                text = value.as_py() or ""
                raw = text.encode().translate(None, DELETED)
                sha.append(hashlib.sha256(raw).digest())
                md5.append(hashlib.md5(raw).digest())
                n_bytes.append(len(raw))
                n_chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_chars, pa.int32()),
                    pa.array(sha, pa.binary()),
                    pa.array(md5, pa.binary()),
                    pa.array(n_bytes, pa.int64()),
                    batch.column(FILE_KEY),
                    batch.column(ROW_KEY),
                ],
                names=["doc_id", "n_chars", "sha", "md5", "n_bytes", FILE_KEY, ROW_KEY],
            )

    narrow = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", FILE_KEY, ROW_KEY)
    return narrow.mapInArrow(run, DIGESTS)


def _precedence():
    """The row that stays is the smallest: most code points, smallest id (null last), first in file order."""
    return F.struct(
        (-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("anonymous"), "doc_id", FILE_KEY, ROW_KEY
    )


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per distinct text: its digests, the row that stays and how many rows there are."""
    return rows.groupBy("sha", "md5", "n_bytes").agg(F.min(_precedence()).alias("best"), F.count("*").alias("size"))


def _first_long(sha: str = "sha"):
    """The first eight bytes of a digest as a long."""
    hexed = F.hex(F.substring(F.col(sha), 1, 8))
    high, low = F.conv(F.substring(hexed, 1, 8), 16, 10), F.conv(F.substring(hexed, 9, 8), 16, 10)
    return F.shiftleft(high.cast("long"), 32).bitwiseOR(low.cast("long"))


class Snapshot:
    """An immutable set of known texts: ``groups`` and ``filters`` below one folder, both written once."""

    def __init__(self, spark: SparkSession, path: str, shards: int):
        self.spark, self.path, self.shards = spark, path, shards

    @property
    def groups(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/groups")

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema(FILTERS).parquet(f"{self.path}/filters")

    @classmethod
    def write(cls, groups: DataFrame, path: str) -> Snapshot:
        spark = groups.sparkSession
        groups.write.mode("error").parquet(f"{path}/groups")
        stored = spark.read.parquet(f"{path}/groups")
        shards = max(1, -(-stored.count() // SHARD_KEYS))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            keys = np.unique(pdf["key"].to_numpy(np.int64)).view(np.uint64)
            seed, segment, segments, prints = build_filter(keys)
            return pd.DataFrame([(pdf["shard"].iloc[0], seed, segment, segments, prints)], columns=["shard", "seed", "segment", "segments", "prints"])

        keyed = stored.select(_first_long().alias("key")).select("key", _shard(shards))
        keyed.groupBy("shard").applyInPandas(build, FILTERS).write.mode("error").parquet(f"{path}/filters")
        return cls(spark, path, shards)

    def screen(self, batch: DataFrame) -> DataFrame:
        """``batch`` (one row per distinct text) with ``maybe``: whether its shard's filter has it."""

        def ask(pdf: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            maybe = np.zeros(len(pdf), bool)
            for row in filters.itertuples():
                maybe |= may_contain(pdf["key"].to_numpy(np.int64).view(np.uint64), row.seed, row.segment, row.segments, row.prints)
            return pd.DataFrame({"sha": pdf["sha"], "md5": pdf["md5"], "n_bytes": pdf["n_bytes"], "maybe": maybe})

        salts = max(1, -(-batch.count() // (self.shards * SHARD_KEYS)))  # a batch may be larger than the snapshot
        salt = F.pmod(F.xxhash64("key", F.lit("salt")), F.lit(salts)).cast("int").alias("salt")
        asked = batch.select(*KEY, _first_long().alias("key")).select("*", _shard(self.shards), salt)
        filters = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return (
            asked.groupBy("shard", "salt")
            .cogroup(filters.groupBy("shard", "salt"))
            .applyInPandas(ask, "sha binary, md5 binary, n_bytes long, maybe boolean")
        )


def _shard(shards: int):
    """Shards are dealt by other bits than the filter's slots use."""
    return F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")


def dedup_batch(snapshot: Snapshot, rows: DataFrame) -> DataFrame:
    """Groups of the snapshot and the batch ``rows`` together: one row per distinct text of either."""
    batch = materialize(groups_of(rows), "exact-batch")
    screened = materialize(snapshot.screen(batch), "exact-screened")
    maybe = batch.join(screened.filter("maybe"), KEY, "left_semi")
    surely_new = batch.join(screened.filter("not maybe"), KEY, "left_semi")
    known = snapshot.groups
    merged = known.withColumnsRenamed({"best": "k_best", "size": "k_size"}).join(maybe, KEY, "full_outer")
    merged = merged.select(
        *KEY,
        F.least("k_best", "best").alias("best"),
        (F.coalesce("k_size", F.lit(0)) + F.coalesce("size", F.lit(0))).alias("size"),
    )
    return merged.unionByName(surely_new)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, sha, row key)`` of every row.

    The rows go in as two arrivals, dealt by a hash of their key: the first becomes an immutable snapshot, the
    second is a new batch screened by its filters. The outcome does not depend on the deal.
    """
    spark = docs.sparkSession
    rows = materialize(digests(with_row_key(docs)), "exact-digests")
    second = F.pmod(F.xxhash64(FILE_KEY, ROW_KEY), F.lit(2)) == 1
    snapshot = Snapshot.write(groups_of(rows.filter(~second)), scratch_dir(spark, "exact-snapshot"))
    groups = dedup_batch(snapshot, rows.filter(second))
    best = F.col("best")
    return rows.join(groups, KEY).select(
        "doc_id",
        best["doc_id"].alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col(FILE_KEY) == best[FILE_KEY]) & (F.col(ROW_KEY) == best[ROW_KEY])).alias("kept"),
        "sha",
        FILE_KEY,
        ROW_KEY,
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group that stays."""
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


OP10_SQL = r"""
WITH normalised AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id ASC NULLS LAST) AS rank,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id ASC NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM normalised)
SELECT doc_id, keep_id, group_size, rank = 1 AS kept, text_sha256 FROM ranked
"""
