"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document's set holds the 64-bit hashes of its distinct word shingles. Shingles fall into ``BINS`` bins; one permutation shuffles the
bins, and one second permutation, circularly shifted by 1, 2, 3, ..., yields every signature coordinate. Shifts read neighbouring
entries, so one shingle contributes all coordinates from one run of memory. ``BANDS`` bands of ``ROWS`` coordinates miss a pair
at a similarity of exactly 0.8 with a chance of about 3e-6.

Equal sets are one node (a class), so copies never multiply. Buckets with equal members are one bucket. Candidate pairs are
not all pairs of a bucket: each round compares the members of a bucket with one representative, on full sets, and
joins what is linked into components; only members that are still in different components go on. After ``STAR_ROUNDS`` rounds every
pair of a bucket that is still in different components is compared on full sets, in blocks within tasks, so no link between components is
lost. Components come from alternating large and small stars, each a join and an aggregate, written to the shared folder.

Hot groups: all groupings have partial aggregates; joins are plain equi-joins between written tables, which
Spark splits. Nothing per document, pair or component reaches the driver.

Defined cases: a text without words (or null) has the empty set and is linked with nothing; fewer words than a shingle are
one shingle; repeated rows are one class; a null id loses against any id as the smallest of a component; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import FILE_KEY, ROW_KEY, table, with_row_key

BINS = 1 << 20
BANDS, ROWS = 42, 6
STAR_ROUNDS = 2
#: Members of a bucket that are compared in one group.
CELL = 512
#: Bytes of text that are hashed together, and shingles whose signatures are folded together.
PIECE, FOLD = 4 << 20, 4096
SEED = 20240229
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# ---- sets and signatures


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: words without ASCII white space, A-Z in lower case."""
    lists = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = [w for words in lists for w in words]
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, np.uint64)
    at = 0
    for words in lists:
        h = hashes[at : at + len(words)]
        at += len(words)
        width = min(k, len(h))
        if not width:
            yield np.zeros(0, np.uint64)
            continue
        rolled = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            rolled = rolled * _A + _mix(h[i : len(h) - width + 1 + i])
        yield np.unique(_mix(rolled))


class CirculantMinHash:
    def __init__(self, size: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size = size
        self.first = rng.permutation(BINS).astype(np.int32)
        second = rng.permutation(BINS).astype(np.int32)
        # row p of the view is the second permutation from p on: its shifts by 0, 1, 2, ...
        self.shifts = np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:size]]), size)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        places = self.first[(hashes & np.uint64(BINS - 1)).astype(np.int64)]
        out = np.full(self.size, BINS, np.int32)
        for at in range(0, len(places), FOLD):
            np.minimum(out, self.shifts[places[at : at + FOLD]].min(axis=0), out=out)
        return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in rows.T:
        key = _mix(key * _A + column)
    return key.view(np.int64)


def _in_pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """``(first row, texts)`` of runs of rows with about ``PIECE`` characters."""
    texts, start, size = [], 0, 0
    for i, value in enumerate(batch.column("text")):
        text = value.as_py()
        texts.append(text)
        size += len(text or "")
        if size >= PIECE:
            yield start, texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield start, texts


FEATURES = f"doc_id long, {FILE_KEY} long, {ROW_KEY} long, uid long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def features(keyed: DataFrame, k: int) -> DataFrame:
    """Set size, 128-bit set fingerprint and band keys of every row of ``with_row_key(docs)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, uid = CirculantMinHash(BANDS * ROWS), TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, texts in _in_pieces(batch):
                n, fp1, fp2, bands = [], [], [], []
                for s in shingle_sets(texts, k):
                    n.append(len(s))
                    fp1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    fp2.append(int(_mix(s ^ _A).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    bands.append(band_keys(hasher.signature(s)) if len(s) else None)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column(FILE_KEY),
                        part.column(ROW_KEY),
                        pa.array(range(uid, uid + len(texts)), pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(fp1, pa.int64()),
                        pa.array(fp2, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", FILE_KEY, ROW_KEY, "uid", "n_shingles", "fp1", "fp2", "bands"],
                )
                uid += len(texts)

    return keyed.select(F.col("doc_id").cast("long").alias("doc_id"), FILE_KEY, ROW_KEY, "text").mapInArrow(run, FEATURES)


def full_sets(rows: DataFrame, k: int) -> DataFrame:
    """``(node, shingles)`` of ``rows(node, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _in_pieces(batch):
                sets = [s.view(np.int64) for s in shingle_sets(texts, k)]
                nodes = batch.slice(start, len(texts)).column("node")
                yield pa.RecordBatch.from_arrays([nodes, pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


# ---- components


def components(links: DataFrame, turns: int | None = None) -> DataFrame:
    """``(node, label)``: the smallest node reachable over ``links(a, b)``, for every node in a link.

    After a given number of ``turns`` the labels may be unfinished: nodes with equal labels are connected, but not the reverse.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges, seen = materialize(edges, "edges"), None
    while turns is None or turns > 0:
        turns = turns if turns is None else turns - 1
        # large star: neighbours above u point to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = materialize(large, "star")
        # small star: u and its neighbours below point to the smallest of them
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u != v").distinct(), "edges")
        if turns == 0:
            break
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen:
            break
        seen = state
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")))
        .groupBy("node")
        .agg(F.min("label").alias("label"))
    )


# ---- groups


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``(band, node, label)``; a node without links is its own label."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))


def _star_pairs(labelled: DataFrame, salt: int) -> DataFrame:
    """Each member of a bucket against its representative, where their components differ."""
    best = labelled.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "label")).alias("r"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    best = materialize(best.filter("lo != hi").select("band", F.col("r.node").alias("b"), F.col("r.label").alias("b_label")), "stars")
    pairs = labelled.join(best, "band").filter("label != b_label")
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _open_links(labelled: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Links between members of a bucket that are still in different components, as few as join the components.

    Members bring their full sets. A bucket of more than ``CELL`` members is cut into blocks, and every pair of blocks is a
    group of its own. All pairs of different components are compared there; of the links found, those that join
    what is not yet joined within the group are given out.
    """
    ends = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
    ends = materialize(ends.filter("lo != hi").select("band", F.ceil(F.col("m") / CELL).cast("int").alias("blocks")), "open-buckets")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    still = labelled.join(ends, "band").select("band", "node", "label", "blocks", mine.alias("mine"))
    cells = materialize(still, "open").join(sets, "node").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        node, mine = cell["node"].to_numpy(), cell["mine"].to_numpy()
        values, label, counts = np.unique(cell["label"].to_numpy(), return_inverse=True, return_counts=True)
        rows = [np.asarray(x, np.int64) for x in cell["shingles"]]
        length = np.array([len(r) for r in rows])
        flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), length)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        parent, across = list(range(len(values))), mine.min() != mine.max()

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for x in np.flatnonzero(label != counts.argmax()):
            at, to = np.searchsorted(flat, rows[x]), np.searchsorted(flat, rows[x], side="right")
            reach = np.repeat(at - (np.cumsum(to - at) - (to - at)), to - at) + np.arange((to - at).sum())
            shared = np.bincount(owner[reach], minlength=len(rows))
            near = shared * least[1] >= (length[x] + length - shared) * least[0]
            near &= (label != label[x]) & ((mine != mine[x]) | (not across))
            for y in np.flatnonzero(near):
                p, q = root(label[x]), root(label[y])
                if p != q:
                    parent[p] = q
                    links.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    low, high = F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    return cells.groupBy("band", low, high).applyInPandas(compare, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets have ``least[1] * intersection >= least[0] * union``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("n"))
    return joined.filter(F.col("i") * least[1] >= (F.col("n") - F.col("i")) * least[0]).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, least: tuple[int, int] = (80, 100)) -> DataFrame:
    """``(doc_id, n_shingles, component_id, stays, row key)`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest id of the component; exactly one row of a component ``stays``.
    """
    keyed = with_row_key(docs)
    rows = materialize(features(keyed, k), "near-features")
    classes = materialize(
        rows.filter("n_shingles > 0")
        .groupBy("fp1", "fp2", "n_shingles")
        .agg(
            F.min(F.struct("uid", FILE_KEY, ROW_KEY)).alias("rep"),
            F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", FILE_KEY, ROW_KEY)).alias("best"),
        ),
        "near-classes",
    )
    nodes = classes.select(F.col("rep.uid").alias("node"), f"rep.{FILE_KEY}", f"rep.{ROW_KEY}")

    banded = rows.select(F.col("uid").alias("node"), "bands").join(nodes.select("node"), "node", "left_semi")
    banded = banded.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("first"), F.bit_xor(F.xxhash64("node")).alias("x"))
    distinct = shared.filter("n > 1").groupBy("n", "first", "x").agg(F.min("band").alias("band")).select("band")
    members = materialize(banded.join(materialize(distinct, "near-buckets"), "band"), "near-members")

    needed = nodes.join(members.select("node").distinct(), "node", "left_semi")
    texts = keyed.select(FILE_KEY, ROW_KEY, "text").join(needed, [FILE_KEY, ROW_KEY])
    sets = materialize(full_sets(texts, k), "near-sets")

    links, labels = None, None
    for turn in range(STAR_ROUNDS + 1):
        labelled = _labelled(members, labels)
        if turn < STAR_ROUNDS:
            found = _verified(_star_pairs(labelled, turn), sets, least)
        else:
            found = _open_links(labelled, sets, least)
        found = materialize(found, "near-links")
        links = found if links is None else links.unionByName(found)
        # until the last round labels only save comparisons, and one turn is enough
        labels = materialize(components(links, 1 if turn < STAR_ROUNDS else None), "near-labels")

    best = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    placed = classes.select("fp1", "fp2", "n_shingles", F.col("rep.uid").alias("node"), "best").join(best, "node")
    winners = materialize(placed.groupBy("label").agg(F.min("best").alias("winner")), "near-winners")
    outcome = materialize(placed.join(winners, "label").select("fp1", "fp2", "n_shingles", "winner"), "near-outcome")
    joined = rows.select("doc_id", FILE_KEY, ROW_KEY, "n_shingles", "fp1", "fp2").join(outcome, ["fp1", "fp2", "n_shingles"], "left")
    alone = F.col("n_shingles") == 0
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("component_id"),
        (alone | ((F.col(FILE_KEY) == F.col(f"winner.{FILE_KEY}")) & (F.col(ROW_KEY) == F.col(f"winner.{ROW_KEY}")))).alias("stays"),
        FILE_KEY,
        ROW_KEY,
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents over links of two-word shingle sets."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=2)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
