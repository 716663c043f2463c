"""Toxicity scores by non-negative positive-unlabelled learning.

Features are the distinct hashed words of a text (runs of letters, lower case) and prefixes of words. A sparse linear classifier is trained
in numpy from confirmed toxic texts and from unlabelled texts of the learning folds, on the class-prior-corrected risk
``prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))`` with the logistic loss: where the bracket turns negative on a batch, its
gradient is reversed. Features are the words that are significantly more frequent among the toxic texts than among all texts: document
counts of every bucket that a toxic text holds come from one combined aggregate over all rows of the learning folds. The prior is the toxic share among all
labelled rows of these folds. A logistic calibration on labelled rows that training did not see turns
margins into scores.

What is sampled, for gradient steps and calibration only, all chosen by the hash of the id: at most ``POSITIVES`` toxic, ``UNLABELLED`` unlabelled and
``LABELLED`` calibration documents, near copies of each other thinned to one. Scores read whole texts.

Defined cases: a null text counts as empty and gets the score of a text without words; without any confirmed
toxic text to learn from every score is 0; several labels of one id count as their largest; repeated rows are scored one by
one; a null id counts as the empty string for the folds and never meets a label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .langid import fold_of

BITS = 20
#: Bytes of a word's prefixes that are features beside the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
POSITIVES, UNLABELLED, LABELLED = 2000, 4000, 2000
#: And if so many sampled toxic texts have it.
LEAST_TEXTS = 4
EPOCHS, BATCH, RATE = 25, 128, 0.5
#: A word is a feature if its share among toxic texts is so many times, and so many standard errors above, its share among all.
RARE = 0.01  # share of texts below which a word tells copies
LEAST_LIFT, LEAST_SIGMAS = 2.5, 6.0
TOXIC_AT = 0.7
SLICE = 1 << 20

_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[b for b in range(128) if not chr(b).isalpha()]] = 32
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_R, 4096), _powers(_R_INVERSE, 4096)


def word_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the words and prefixes of a text, slice by slice; a hash does not depend on where a word stands."""
    global _UP, _DOWN
    whole = _BLANKED[np.frombuffer((text.lower() + " ").encode("utf-8", "replace"), np.uint8)]
    at = 0
    while at < len(whole):
        end = min(len(whole), at + SLICE)
        while end < len(whole) and whole[end - 1] != 32:
            blanks = np.flatnonzero(whole[end : end + SLICE] == 32)
            end = end + int(blanks[0]) + 1 if len(blanks) else min(len(whole), end + SLICE)
        part = whole[at:end]
        at = end
        if len(part) > len(_UP):
            _UP, _DOWN = _powers(_R, 2 * len(part)), _powers(_R_INVERSE, 2 * len(part))
        letter = part != 32
        edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            continue
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        made = [(sums[ends] - sums[starts]) * _DOWN[starts]]
        for length in PREFIXES:
            longer = starts[ends - starts > length]
            made.append((sums[longer + length] - sums[longer]) * _DOWN[longer] + np.uint64(length))
        hashes = np.concatenate(made)
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        yield (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_buckets(text: str) -> np.ndarray:
    parts = [np.unique(p) for p in word_buckets(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by bucket
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def margin(self, text: str) -> float:
        found = [p[self.weights[p] != 0] for p in word_buckets(text)]
        used = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return float(self.weights[used].sum(dtype=np.float64) + self.bias)

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        return float(_sigmoid(self.slope * self.margin(text or "") + self.shift))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def without_near_copies(rows: list[np.ndarray], share: np.ndarray) -> list[np.ndarray]:
    """``rows`` less those that have a third of their rare words in common with an earlier one.

    One text copied often, toxic or labelled so by mistake, must not make its own words look toxic.
    """
    holders: dict[int, list[int]] = {}
    kept = []
    for row in rows:
        rare = row[share[row] < RARE]
        met: dict[int, int] = {}
        for word in rare.tolist():
            for other in holders.get(word, ()):
                met[other] = met.get(other, 0) + 1
        if met and 3 * max(met.values()) >= len(rare):
            continue
        for word in rare.tolist():
            holders.setdefault(word, []).append(len(kept))
        kept.append(row)
    return kept


def _texts_with(rows: list[np.ndarray]) -> np.ndarray:
    return np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]), minlength=1 << BITS)


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], share: np.ndarray, prior: float, seed: int = 11
) -> ToxicityModel:
    """Minimise the non-negative risk by stochastic gradient descent over the significant words.

    ``share`` is the share of all texts that hold a word of each bucket.
    """
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    positive = without_near_copies(positive, share)
    in_p = _texts_with(positive)
    expected = len(positive) * share
    usable = (in_p >= LEAST_TEXTS) & (in_p >= LEAST_LIFT * expected) & (in_p - expected >= LEAST_SIGMAS * np.sqrt(expected))
    positive = [x[usable[x]] for x in positive]
    unlabelled = [x[usable[x]] for x in unlabelled]
    used = np.flatnonzero(usable)
    place = np.zeros(size, np.int64)
    place[used] = np.arange(len(used))
    w, squares, b = np.zeros(len(used)), np.full(len(used), 1e-2), -2.0

    def margins(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = place[np.concatenate([*rows, np.zeros(0, np.int64)])]
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return flat, owner, np.bincount(owner, w[flat], len(rows)) + b

    batches = max(1, -(-len(unlabelled) // BATCH))
    for epoch in range(EPOCHS):
        rate = RATE / (1 + 0.2 * epoch)
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for i in range(batches):
            p_rows = [positive[j] for j in np.take(p_order, np.arange(i * BATCH, (i + 1) * BATCH), mode="wrap")]
            u_rows = [unlabelled[j] for j in u_order[i * BATCH : (i + 1) * BATCH]]
            pf, po, pm = margins(p_rows)
            uf, uo, um = margins(u_rows)
            negative = np.logaddexp(0, um).mean() - prior * np.logaddexp(0, pm).mean()
            # gradients of each part by margin, averaged over its rows
            p_plus, p_minus, u_minus = -_sigmoid(-pm) / len(pm), _sigmoid(pm) / len(pm), _sigmoid(um) / max(1, len(um))
            if negative >= 0:
                gp, gu = prior * (p_plus - p_minus), u_minus
            else:
                gp, gu = prior * p_minus, -u_minus
            grad = np.bincount(pf, gp[po], len(used)) + np.bincount(uf, gu[uo], len(used))
            squares += grad * grad
            step = rate / np.sqrt(squares)
            w = np.maximum(w - step * grad, 0)  # a feature is evidence for toxicity or none
            b -= rate * 0.2 * (gp.sum() + gu.sum())
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return ToxicityModel(weights, float(b))


def calibrate(model: ToxicityModel, rows: list[np.ndarray], labels: np.ndarray) -> ToxicityModel:
    """Fit ``sigmoid(slope * margin + shift)`` to held-back labels by Newton steps; the slope stays positive."""
    if not len(rows) or labels.min() == labels.max():
        return model
    margin = np.array([model.weights[r].sum(dtype=np.float64) + model.bias for r in rows])
    scale = max(1e-6, float(np.abs(margin).max()))
    x = np.stack([margin / scale, np.ones(len(margin))], axis=1)
    beta = np.array([scale, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - labels) + 1e-3 * beta)
        beta -= np.clip(step, -2, 2)
    if beta[0] > 0:
        model.slope, model.shift = float(beta[0] / scale), float(beta[1])
    return model


def _thinned(frame: pd.DataFrame) -> pd.DataFrame:
    """One of those that share the three smallest bucket hashes: near copies and copies go."""
    return frame.drop_duplicates("sketch")


def text_shares(docs: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """The share of all texts of ``docs(text)`` that hold a word of a bucket, for the buckets ``wanted``; one number each reaches the driver."""
    packed = np.packbits(np.bincount(wanted, minlength=1 << BITS).astype(bool))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held, mine = 0, np.zeros(1 << BITS, np.int64), np.unpackbits(packed).astype(bool)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n += 1
                held[distinct_buckets(text or "")] += 1
        used = np.flatnonzero(held * mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(held[used], n))], names=["bucket", "n"]
        )

    # the row of bucket -1 counts texts
    found = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    bucket, n = found["bucket"].to_numpy(np.int64), found["n"].to_numpy(np.float64)
    texts, out = n[bucket < 0].sum(), np.zeros(1 << BITS)
    out[bucket[bucket >= 0]] = n[bucket >= 0]
    return (out + 0.5) / (texts + 1)


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> ToxicityModel:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, from rows for which ``usable`` holds only."""
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.select("*", order.alias("order")).withColumn("held_back", F.pmod("order", F.lit(4)) == 0)
    prior = known.agg(F.avg(F.col("toxic").cast("double")).alias("p")).first()["p"]
    if not prior:
        return ToxicityModel(np.zeros(1 << BITS, np.float32), 0.0, constant=0.0)

    def chosen(rows: DataFrame, n: int, role: str) -> DataFrame:
        return rows.orderBy("order", "doc_id").limit(n).select("doc_id", F.lit(role).alias("role"), "toxic")

    everyone = docs.filter(usable & F.col("doc_id").isNotNull()).select("doc_id", order.alias("order"), F.lit(None).cast("int").alias("toxic"))
    roles = (
        chosen(known.filter("toxic = 1 and not held_back"), POSITIVES, "positive")
        .unionByName(chosen(known.filter("held_back"), LABELLED, "labelled"))
        .unionByName(chosen(everyone.filter("pmod(order, 4) != 0"), UNLABELLED, "unlabelled"))
    )

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [distinct_buckets(t or "") for t in frame["text"]]
            mixed = [np.sort((s * 2654435761) & 0xFFFFFFFF)[:3].tolist() for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "role": frame["role"],
                    "toxic": frame["toxic"],
                    "sketch": [",".join(map(str, m)) for m in mixed],
                    "buckets": [s.astype(np.int32).tobytes() for s in sets],
                }
            )

    # the chosen ids are bounded by the three parameters, so their side may be sent to every task
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(roles), "doc_id")
        .mapInPandas(features, "doc_id long, role string, toxic int, sketch string, buckets binary")
        .dropDuplicates(["role", "doc_id"])  # as many rows as were chosen, even where an id repeats
        .toPandas()
        .sort_values(["role", "doc_id", "sketch"], kind="stable")
    )
    sets = {role: _thinned(part) for role, part in rows.groupby("role")}

    def of(role: str) -> list[np.ndarray]:
        return [np.frombuffer(b, np.int32).astype(np.int64) for b in sets[role]["buckets"]] if role in sets else []

    if not of("positive"):
        return ToxicityModel(np.zeros(1 << BITS, np.float32), 0.0, constant=0.0)
    positive = of("positive")
    share = text_shares(docs.filter(usable), np.concatenate(positive))  # a feature is a word of a toxic text
    model = train(positive, of("unlabelled"), share, float(prior))
    return calibrate(model, of("labelled"), sets["labelled"]["toxic"].to_numpy(float)) if "labelled" in sets else model


def score_texts(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, then ``score`` and ``predicted`` of each whole ``text``."""
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = source.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t) for t in batch.column("__text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), pa.array((scores >= TOXIC_AT).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    return source.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two of three folds of ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of("doc_id", 3) == 1
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held_out)
    return score_texts(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])
