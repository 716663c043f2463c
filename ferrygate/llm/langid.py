"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and its byte n-grams (2 to 4 bytes) are hashed into buckets. The
mean of the buckets' embeddings goes through a linear softmax. Both are trained together by stochastic gradient
descent in numpy on a bounded sample: about ``PER_LANGUAGE`` documents of each language by the hash of the id, ``WINDOWS`` windows of
``WINDOW`` letters from each. Predictions read whole texts, in slices of constant memory; embedding and softmax are
multiplied into one bucket-by-language table first.

Calibration, on sampled documents that training did not see: a temperature that minimises the log loss of whole
documents, and two bounds below which a text is rejected. One is on the best language's probability: its ``REJECT`` quantile, at most one
half (what is more likely than not is never rejected). The other is on familiarity, the mean log frequency of a text's n-grams in the
training windows: softmax is as sure of noise and unseen scripts as of its languages, familiarity falls with them. The bound lies
``REACH`` times as far below the median as the 5 % quantile of the least familiar language, and further below for short texts, whose mean is
less certain. Both are quantiles that the held-back rows support and neither looks at a label, so wrong labels do not move them. With fewer than
``LEAST_ROWS`` held-back rows nothing is rejected for being unfamiliar.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected; where nothing can be
learned (an empty table, no languages) every text is ``und`` with score 0 and only texts without a letter count as
rejected; repeated rows are scored one by one; a null id counts as the empty string for the folds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BUCKETS, DIM, ORDERS = 1 << 16, 16, (2, 3, 4)
PER_LANGUAGE, WINDOWS, WINDOW = 1500, 4, 240
EPOCHS, BATCH, RATE = 4, 32, 2.0
REJECT = 0.005
#: Distance of the familiarity bound, held-back rows it needs, and n-grams of a text for which it lies 1.4 times as far away.
REACH, LEAST_ROWS, SHORT = 3.0, 20, 60
UNKNOWN = "und"
#: Bytes that are hashed at a time.
SLICE = 1 << 20

_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[b for b in range(128) if not chr(b).isalpha()]] = 32
_LETTER = regex.compile(r"\p{L}")


def fold_of(doc_id: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def subword_ids(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the byte n-grams of a text, slice by slice."""
    whole = _BLANKED[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)]
    top = max(ORDERS)
    for at in range(0, len(whole), SLICE):
        part = whole[at : at + SLICE + top - 1].astype(np.uint32)
        gram, made = part, []
        for order in range(2, top + 1):
            gram = (gram[:-1] << np.uint32(8)) | part[order - 1 :]
            if order in ORDERS:
                used = gram[: SLICE][(gram[:SLICE] & np.uint32(0xFFFF)) != 0x2020]
                made.append((used * np.uint32(2654435761) + np.uint32(order * 40503)) >> np.uint32(16))
        yield np.concatenate(made)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # bucket by language, then one column of log frequencies
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    usual: float = 0.0  # median familiarity
    reach: float = np.inf  # how far below it a long text may be

    def measured(self, text: str) -> tuple[np.ndarray, float, int]:
        """Logits, familiarity and number of n-grams of a text."""
        total, n = np.zeros(len(self.languages) + 1), 0
        for ids in subword_ids(text):
            total += self.scores[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        mean = total / max(n, 1)
        return mean[:-1] + self.bias, float(mean[-1]), n

    def unfamiliar(self, familiarity: float, n: int) -> bool:
        return bool(n and self.usual - familiarity > self.reach * np.sqrt(1 + SHORT / n))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        languages, scores, rejected = [], [], []
        for text in texts:
            if text is None or not _LETTER.search(text):
                languages.append(UNKNOWN), scores.append(0.0), rejected.append(True)
            elif not self.languages:
                languages.append(UNKNOWN), scores.append(0.0), rejected.append(False)
            else:
                logits, familiarity, n = self.measured(text)
                p = _softmax(logits[None] / self.temperature)[0]
                best = int(p.argmax())
                languages.append(self.languages[best]), scores.append(float(p[best]))
                rejected.append(bool(p[best] < self.threshold) or self.unfamiliar(familiarity, n))
        return languages, scores, rejected


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: list[str], targets: np.ndarray, languages: list[str], seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over the embeddings and the softmax at once."""
    rng = np.random.default_rng(seed)
    ids = [np.concatenate(list(subword_ids(w))).astype(np.uint16) for w in windows]
    ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
    every = np.concatenate(ids)
    del ids
    table_ = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    n = len(windows)
    steps, step = EPOCHS * -(-n // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            rows = order[at : at + BATCH]
            flat = np.concatenate([every[ends[r] : ends[r + 1]] for r in rows])
            sizes = ends[rows + 1] - ends[rows]
            lengths, owner = np.maximum(sizes, 1), np.repeat(np.arange(len(rows)), sizes)
            hidden = np.zeros((len(rows), DIM), np.float32)
            np.add.at(hidden, owner, table_[flat])
            hidden /= lengths[:, None]
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), targets[rows]] -= 1
            back = (error @ weights.T) * (rate / lengths)[:, None]
            weights -= rate / len(rows) * (hidden.T @ error)
            bias -= rate / len(rows) * error.sum(axis=0) * 0.1
            np.subtract.at(table_, flat, back[owner].astype(np.float32))
    counts = np.bincount(every, minlength=BUCKETS) + 0.5
    frequency = np.log(counts / counts.sum()).astype(np.float32)
    return LanguageModel(languages, np.column_stack([table_ @ weights, frequency]), bias)


def _sampled(docs: DataFrame, usable: Column) -> tuple[DataFrame, list[str]]:
    """A bounded sample per language by the hash of the id, and the languages in order."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language, as many as the model has classes
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return rows.limit(0), []
    order = F.xxhash64("doc_id", F.lit("langid"))
    share = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for row in counts:
        wanted = wanted | ((F.col("lang") == row["lang"]) & (share < PER_LANGUAGE / row["n"]))
    sample = rows.filter(wanted).select("lang", "text", order.alias("order")).limit(2 * PER_LANGUAGE * len(counts))
    return sample, sorted(row["lang"] for row in counts)


def fit(docs: DataFrame, usable: Column) -> LanguageModel:
    """Learn from the rows of ``docs(doc_id, text, lang)`` for which ``usable`` holds."""
    sample, languages = _sampled(docs, usable)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 1), np.float32), np.zeros(0))
    calibration = F.pmod(F.col("order"), F.lit(4)) == 0

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lang, text, order in frame[["lang", "text", "order"]].itertuples(index=False):
                rng = np.random.default_rng(order & 0x7FFFFFFF)
                for start in rng.integers(0, max(1, len(text) - WINDOW), WINDOWS):
                    out.append((lang, order, int(start), text[start : start + WINDOW]))
            yield pd.DataFrame(out, columns=["lang", "order", "start", "window"])

    drawn = sample.filter(~calibration).mapInPandas(cut, "lang string, order long, start long, window string").toPandas()
    drawn = drawn.sort_values(["lang", "order", "start", "window"], kind="stable")
    if drawn.empty:  # too few rows to hold some back
        drawn = sample.mapInPandas(cut, "lang string, order long, start long, window string").toPandas()
        drawn = drawn.sort_values(["lang", "order", "start", "window"], kind="stable")
    place = {lang: i for i, lang in enumerate(languages)}
    model = train(drawn["window"].tolist(), drawn["lang"].map(place).to_numpy(), languages)
    return _calibrated(model, sample.filter(calibration), place)


def _calibrated(model: LanguageModel, held_back: DataFrame, place: dict[str, int]) -> LanguageModel:
    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for lang, text in zip(frame["lang"], frame["text"]):
                if _LETTER.search(text):
                    logits, familiarity, n = model.measured(text)
                    out.append((lang, logits.tolist(), familiarity, n))
            yield pd.DataFrame(out, columns=["lang", "logits", "familiarity", "n"])

    rows = held_back.mapInPandas(whole, "lang string, logits array<double>, familiarity double, n long").toPandas()
    if rows.empty:
        return model
    logits, truth = np.array(rows["logits"].tolist()), rows["lang"].map(place).to_numpy()
    at = np.arange(len(truth))
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_softmax(logits / t)[at, truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    model.threshold = float(min(0.5, np.quantile(_softmax(logits / model.temperature).max(axis=1), REJECT)))
    taken, long = logits.argmax(axis=1), rows["n"].to_numpy() >= SHORT
    groups = [rows["familiarity"].to_numpy()[long & (taken == i)] for i in place.values()]
    groups = [g for g in groups if len(g) >= LEAST_ROWS]
    if groups:
        model.usual = float(np.median(np.concatenate(groups)))
        model.reach = REACH * (model.usual - min(float(np.quantile(g, 0.05)) for g in groups))
    return model


def identify(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, then ``lang_pred``, ``score`` and ``rejected`` of each whole ``text``."""
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = source.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores, rejected = model.predict(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(languages, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
            )

    return source.mapInArrow(run, schema)


def rejects(model: LanguageModel):
    """A column function: whether the model rejects a text, for filters that leave all other columns alone."""

    @F.pandas_udf("boolean")
    def rejected(text: pd.Series) -> pd.Series:
        return pd.Series(model.predict([None if t is None else str(t) for t in text])[2])

    return rejected


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds of ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold_of("doc_id", 4) == 2
    model = fit(docs, ~held_out)
    return identify(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])
