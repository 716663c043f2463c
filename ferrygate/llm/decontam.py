"""Benchmark decontamination by latent semantic retrieval, then exact sequence checks.

Benchmark items are cut into passages of up to ``PASSAGE`` words. Their TF-IDF rows and those of all passages of the corpus get a randomised singular
value decomposition of rank ``LATENT_RANK``: document frequencies, the sketch, its power iterations and the small Gram matrix are sums over the
distributed rows, only matrices of terms by rank meet on the driver. Every word has a place in that space: the benchmark's words have a column each,
all others share ``BUCKETS`` columns by their hash, with a sign, so that what shares a column cancels out on average; a word that no item holds
lies near those it occurs with.

Windows of every whole document are candidates on one of three grounds: the TF-IDF cosine with a passage is at least ``COSINE``; or a
wider window holds ``PARAPHRASE`` of a passage's words, so that no length makes the search narrower than the checks (an item is cut
so that a place with that share of the item has it for one of the passages); or a wider window holds the words of the item's answer, and the
rest of it has a cosine of at least ``LATENT`` with the rest of the passage in the latent space: a paraphrase in other words. Common words alone
do not count: in the last two the words held must weigh at least ``WEIGHT`` of the passage (sum of squared idf).

No ground holds unless the words that a window shares with a passage have a certain weight. Sums of weights over blocks of ``COARSE`` words, from
postings without a passage's lightest words (whose whole weight is taken as shared), are upper bounds of it: they rule out
most places without loss, and only the others are compared.

A candidate is confirmed on the words around it: the longest common subsequence holds at least ``WHOLE`` of the item;
or at least ``PARAPHRASE`` of it, or a place near it in the latent space, and the item's answer (its last sentence) is there too; or at
least ``PART`` of a passage of ``LONG_PASSAGE`` words or more, for items quoted in part. A place found in the latent space counts only for answers of
``TELLING`` words or more, of which the window holds ``TOLD`` in order, and what it holds of them weighs ``WEIGHT`` of the passage.

Size: documents are never shuffled or grouped. The benchmark is the stated query set: it is searched in blocks of at most ``RANK`` passages,
two passes over the texts each: the first writes the numbers of their latent terms, two bytes a word, which the decomposition reads once per
product. What is sent to tasks is bounded by a block's vocabulary times ``RANK`` and ``BUCKETS`` times ``LATENT_RANK``. An item with more passages
than that is searched in several blocks, each time with the whole item to confirm.

Defined cases: a null text has no words and leaks nothing; items of fewer than ``LEAST_WORDS`` words (or null) are not searched
for; items with equal texts are each reported; repeated rows are reported one by one; a null id is reported as null; an empty
table or benchmark gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FILE_KEY, ROW_KEY, table, with_row_key
from ..session import materialize, release

PASSAGE, STEP = 32, 16
#: Words of a window compared by cosine, of one compared by words held, and stride: for passages of ``SHORT`` words or more, and for shorter ones.
SCALES = ((32, 56, 8), (12, 24, 4))
SHORT = 16
LEAST_WORDS = 5
COSINE, WHOLE, PARAPHRASE, ANSWER, PART, LONG_PASSAGE = 0.55, 0.7, 0.5, 0.6, 0.8, 20
#: On the given tables chance places with ``PARAPHRASE`` of the words weigh under 0.1, planted ones over 0.2.
WEIGHT = 0.15
#: Passages of a block.
RANK = 640
LATENT_RANK, OVERSAMPLE, POWER = 64, 10, 2
#: Columns of the latent space for the words that no item holds. A block has at most ``RANK`` times ``PASSAGE + STEP`` words of its own, so that
#: two bytes number its words and the buckets with either sign.
BUCKETS = 1 << 14
LATENT, TELLING, TOLD = 0.6, 4, 0.8
#: Words of a block of the screen (no window is wider), and the share of what is needed that a passage's lightest words may make up.
COARSE, LIGHT = 64, 0.4
GROUP = 1 << 18  # bytes of text handled at once
CHUNK = 512  # terms per row of a partial matrix
#: Passages of a row of the written corpus, those multiplied at once, rows summed at once, and summands of a partial sum.
ROW_PASSAGES, PASSAGES, TILE, SUMMANDS = 4096, 1 << 14, 1024, 8
#: Passages of a task: it sends a matrix of all columns, so that there are no more tasks than cores, and at last one for so many passages.
FEW, MANY = 1 << 16, 1 << 21
SEED = 5

_BLANKED = np.arange(256, dtype=np.uint8)
_BLANKED[[b for b in range(128) if not chr(b).isalnum()]] = 32
_R = 0x9E3779B97F4A7C15


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs of letters and digits, lower case) in order."""
    whole = _BLANKED[np.frombuffer((text.lower() + " ").encode("utf-8", "replace"), np.uint8)]
    out = []
    at, piece = 0, 1 << 20
    while at < len(whole):
        end = min(len(whole), at + piece)
        while end < len(whole) and whole[end - 1] != 32:
            blanks = np.flatnonzero(whole[end : end + piece] == 32)
            end = end + int(blanks[0]) + 1 if len(blanks) else min(len(whole), end + piece)
        out.append(_hash_words(whole[at:end])[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def grouped(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first, hashes, bounds)``: words of texts from number ``first`` on, one text after the other; text ``i`` has those between bounds ``i`` and ``i + 1``."""
    held, size, first = [], 0, 0

    def hashed() -> tuple[int, np.ndarray, np.ndarray]:
        hashes, starts = _hash_words(_BLANKED[np.frombuffer(b"".join(held), np.uint8)])
        ends = np.cumsum([len(raw) for raw in held])
        return first, hashes, np.append(0, np.searchsorted(starts, ends))

    for number, value in enumerate(texts.to_pylist()):
        raw = ((value or "").lower() + " ").encode("utf-8", "replace")
        if held and size + len(raw) > GROUP:
            yield hashed()
            held, size, first = [], 0, number
        if len(raw) > GROUP:
            hashes = word_hashes(value)
            yield number, hashes, np.array([0, len(hashes)])
            first = number + 1
        else:
            held.append(raw)
            size += len(raw)
    if held:
        yield hashed()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_R, 4096), _powers(pow(_R, -1, 1 << 64), 4096)


def _hash_words(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of blanked bytes, and where they begin."""
    global _UP, _DOWN
    if len(part) > len(_UP):
        _UP, _DOWN = _powers(_R, 2 * len(part)), _powers(pow(_R, -1, 1 << 64), 2 * len(part))
    edges = np.flatnonzero(np.diff(part != 32, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    # a polynomial in the position within the word: a difference of running sums, shifted back by the word's start
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _DOWN[starts]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9), starts


# ---- the latent space of one block of items


@dataclass
class Item:
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray
    passages: list[tuple[int, int]]
    number: int = 0  # in the order of the search
    cut: int = 0  # passages of the whole item


def _item(item_id: int | None, text: str) -> Item:
    words = word_hashes(text)
    sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if len(word_hashes(s))]
    answer = word_hashes(sentences[-1]) if len(sentences) > 1 else words[-max(1, len(words) // 4) :]
    n = len(words)
    starts = list(range(0, max(1, n - PASSAGE + STEP), STEP)) if n > PASSAGE else [0]
    passages = [(a, min(n, a + PASSAGE)) for a in starts]
    if n > PASSAGE and 0 < n % PASSAGE <= STEP:  # a short rest goes with the passage before it, so that some passages cover the item without overlap
        passages.append((n - n % PASSAGE - PASSAGE, n))
    return Item(item_id, words, answer, passages)


@dataclass
class Space:
    items: list[Item]
    owner: np.ndarray  # item of each passage
    length: np.ndarray  # words of each passage
    vocabulary: np.ndarray  # sorted hashes
    counts: np.ndarray  # passages of the corpus that hold each term
    weight: np.ndarray  # idf of each term, then that of any other word
    held: np.ndarray  # term by passage: how often it occurs there; a last row of zeros stands for other words
    answered: np.ndarray  # the same by item, in its answer
    mass: np.ndarray  # squared idf of all words of each passage
    norm: np.ndarray  # norm of each passage
    telling: np.ndarray  # whether an item's answer has ``TELLING`` words
    folds: np.ndarray  # latent rows, scaled by idf, of the vocabulary and of the buckets with either sign
    rest: np.ndarray  # unit latent rows of passages without the answer's words

    def screen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(places, passages, weights)``: postings of each term, from ``places`` on. The weights that a window shares with a passage that it
        is a candidate for add up to 1: its light words are taken as shared, and left out."""
        terms, passages = np.nonzero(self.held)
        tf, square = self.held[terms, passages].astype(float), self.weight[terms] ** 2
        # a cosine is at most the norm of the passage's shared words, for unit passages
        share = np.maximum(tf * square / (WEIGHT * self.mass[passages]), tf**2 * square / (COSINE * self.norm[passages]) ** 2)
        order = np.lexsort((-self.counts[terms] / share, passages))
        terms, passages, share = terms[order], passages[order], share[order]
        total = np.cumsum(share)
        first = np.searchsorted(passages, passages)
        light = total - (total[first] - share[first]) <= LIGHT
        need = 1 - np.bincount(passages, share * light, len(self.length)) - 1e-6
        order = np.flatnonzero(~light)[np.argsort(terms[~light], kind="stable")]
        places = np.searchsorted(terms[order], np.arange(len(self.vocabulary) + 2))
        return places, passages[order], share[order] / need[passages[order]]


def corpus_passages(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """All passages of the corpus, written once: latent terms of ``PASSAGE`` words each, in order, the last of a text filled up with one more number."""
    size = len(vocabulary) + 2 * BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _sieve(vocabulary)
        for batch in batches:
            for _, h, bounds in grouped(batch.column(0)):
                lengths = np.diff(bounds)
                first = np.cumsum(-(-lengths // PASSAGE))
                out = np.full(int(first[-1]) * PASSAGE, size, np.uint16)
                out[np.repeat(np.append(0, first[:-1]) * PASSAGE - bounds[:-1], lengths) + np.arange(len(h))] = _latent_terms(
                    _lookup(h, vocabulary, sieve), h, len(vocabulary)
                )
                out = out.reshape(-1, PASSAGE)
                out.sort(axis=1)
                rows = [out[i : i + ROW_PASSAGES].tobytes() for i in range(0, len(out), ROW_PASSAGES)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["terms"])

    return materialize(docs.select("text").mapInArrow(run, "terms binary"), "passages")


def term_counts(passages: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many passages of the corpus each latent term occurs, and how many passages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for terms in _blocks_of(batch.column(0).to_pylist()):
                counts += np.bincount(terms[_new_terms(terms)], minlength=size + 1)
                n += len(terms)
        some = np.flatnonzero(counts[:size])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))], names=["term", "n"])

    rows = passages.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    known = rows[rows["term"] >= 0]
    counts[known["term"].to_numpy()] = known["n"].to_numpy()
    return counts, int(rows.loc[rows["term"] == -1, "n"].sum())


def _new_terms(terms: np.ndarray) -> np.ndarray:
    """Which terms of passages, in order, differ from the one before."""
    new = np.ones(terms.shape, bool)
    new[:, 1:] = terms[:, 1:] != terms[:, :-1]
    return new


def _blocks_of(rows: list[bytes]) -> Iterator[np.ndarray]:
    """Passages of written rows, about ``PASSAGES`` at once."""
    held, size = [], 0
    for raw in rows:
        held.append(raw)
        size += len(raw)
        if size >= 2 * PASSAGE * PASSAGES:
            yield np.frombuffer(b"".join(held), np.uint16).reshape(-1, PASSAGE)
            held, size = [], 0
    if size:
        yield np.frombuffer(b"".join(held), np.uint16).reshape(-1, PASSAGE)


def _sieve(vocabulary: np.ndarray) -> np.ndarray:
    """Whether any term has these low bits: most words of a corpus are ruled out by one look."""
    out = np.zeros(1 << 18, bool)
    out[vocabulary & np.uint64(len(out) - 1)] = True
    return out


def _lookup(hashes: np.ndarray, vocabulary: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Numbers of the terms, ``len(vocabulary)`` for other words."""
    out = np.full(len(hashes), len(vocabulary))
    likely = np.flatnonzero(sieve[hashes & np.uint64(len(sieve) - 1)])
    place = np.minimum(np.searchsorted(vocabulary, hashes[likely]), len(vocabulary) - 1)
    hit = vocabulary[place] == hashes[likely]
    out[likely[hit]] = place[hit]
    return out


def _gathered(rows: DataFrame, columns: int, size: int, of_partition) -> np.ndarray:
    """Sum over partitions of ``of_partition(frame)``, a ``size`` by ``columns`` matrix, combined in chunks of rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, columns))
        for frame in frames:
            total += of_partition(frame)
        chunks = range(0, size, CHUNK)
        yield pd.DataFrame({"chunk": list(chunks), "part": [total[c : c + CHUNK].tobytes() for c in chunks]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in frame["part"])
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "part": [total.tobytes()]})

    summed = rows.mapInPandas(run, "chunk long, part binary").groupBy("chunk").applyInPandas(add, "chunk long, part binary")
    parts = summed.toPandas().sort_values("chunk")["part"]
    out = np.zeros((size, columns))
    for chunk, part in enumerate(parts):
        out[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(part).reshape(-1, columns)
    return out


def _sparse(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and weights of the rows one after the other, and where the rows that have some begin."""
    lengths = frame["terms"].map(len).to_numpy(np.int64)
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    return np.concatenate(frame["terms"].to_numpy()).astype(np.int64), np.concatenate(frame["weights"].to_numpy()), np.cumsum(lengths) - lengths


def _times(frame: pd.DataFrame, basis: np.ndarray) -> np.ndarray:
    """The rows times ``basis``, empty ones left out."""
    terms, weights, starts = _sparse(frame)
    return np.add.reduceat(basis[terms] * weights[:, None], starts) if len(starts) else np.zeros((0, basis.shape[1]))


def _normal(frame: pd.DataFrame, basis: np.ndarray) -> np.ndarray:
    """The rows, transposed, times the rows times ``basis``."""
    terms, weights, starts = _sparse(frame)
    out = np.zeros(basis.shape)
    if len(starts):
        back = np.repeat(_times(frame, basis), np.diff(starts, append=len(terms)), axis=0) * weights[:, None]
        order = np.argsort(terms, kind="stable")
        some, first = np.unique(terms[order], return_index=True)
        out[some] = np.add.reduceat(back[order], first)
    return out


@dataclass
class Corpus:
    """Products of the corpus's unit TF-IDF rows, which are written as latent terms. Columns: the vocabulary, then the buckets."""

    idf: np.ndarray  # of each latent term
    v: int  # terms of the vocabulary

    def table(self, basis: np.ndarray) -> np.ndarray:
        """Rows of ``basis`` by latent term, scaled by idf and signed."""
        return basis[self._columns()] * (self.idf * self._signs())[:, None]

    def _columns(self) -> np.ndarray:
        return np.append(np.arange(self.v), self.v + np.arange(len(self.idf) - self.v) // 2)

    def _signs(self) -> np.ndarray:
        return np.append(np.ones(self.v), 1 - 2 * (np.arange(len(self.idf) - self.v) % 2))

    def _squares(self, terms: np.ndarray) -> np.ndarray:
        """Squared norms of passages: a term that occurs ``n`` times counts ``n * n`` times."""
        new = _new_terms(terms)
        at = np.flatnonzero(new)
        each = np.append(self.idf**2, 0)[terms.ravel()[at]] * np.diff(at, append=terms.size) ** 2
        several = new.sum(axis=1)
        return np.add.reduceat(each, np.cumsum(several) - several).astype(np.float32)[:, None]

    def gram(self, frame: pd.DataFrame, basis: np.ndarray) -> np.ndarray:
        """The rows times ``basis``, transposed, times themselves."""
        table, out = _with_zeros(self.table(basis).astype(np.float32)), np.zeros((basis.shape[1],) * 2)
        for terms in _blocks_of(frame["terms"].tolist()):
            rows = (_sums(table, terms.T) / np.sqrt(self._squares(terms))).astype(np.float64)
            out += rows.T @ rows
        return out

    def normal(self, frame: pd.DataFrame, basis: np.ndarray) -> np.ndarray:
        """The rows, transposed, times the rows times ``basis``."""
        table, total = _with_zeros(self.table(basis).astype(np.float32)), np.zeros((len(self.idf) + 1, basis.shape[1]))
        for terms in _blocks_of(frame["terms"].tolist()):
            rows = _sums(table, terms.T) / self._squares(terms)
            order = np.argsort(terms, axis=None, kind="stable")
            _add_sorted(total, terms.ravel()[order], rows, order // PASSAGE)
        total = total[:-1] * (self.idf * self._signs())[:, None]
        return np.append(total[: self.v], total[self.v :: 2] + total[self.v + 1 :: 2], axis=0)


def _with_zeros(rows: np.ndarray) -> np.ndarray:
    return np.append(rows, np.zeros((1, rows.shape[1]), rows.dtype), axis=0)


def _sums(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
    """For each column of ``which`` the sum of the ``rows`` it names; in tiles that stay in the processor's cache."""
    which = np.ascontiguousarray(which)
    out = np.empty((which.shape[1], rows.shape[1]), rows.dtype)
    more = np.empty((TILE, rows.shape[1]), rows.dtype)
    for at in range(0, len(out), TILE):
        tile = out[at : at + TILE]
        np.take(rows, which[0, at : at + TILE], axis=0, out=tile, mode="clip")
        for each in which[1:]:
            tile += np.take(rows, each[at : at + TILE], axis=0, out=more[: len(tile)], mode="clip")
    return out


def _add_sorted(total: np.ndarray, terms: np.ndarray, rows: np.ndarray, which: np.ndarray) -> None:
    """Add to ``total`` by ``terms``, which are sorted, the ``rows`` named by ``which``: sums of ``SUMMANDS`` rows, then of these sums."""
    while len(terms):
        first = np.append(0, np.flatnonzero(terms[1:] != terms[:-1]) + 1)
        count = np.diff(first, append=len(terms))
        sums = -(-count // SUMMANDS)
        begin = np.cumsum(sums) - sums
        slots = np.full(int(sums.sum()) * SUMMANDS, len(rows))
        slots[np.arange(len(terms)) + np.repeat(begin * SUMMANDS - first, count)] = which
        rows = _sums(_with_zeros(rows), slots.reshape(-1, SUMMANDS).T)
        terms = terms[first]
        if len(rows) == len(terms):
            total[terms] += rows
            return
        terms, which = np.repeat(terms, sums), np.arange(len(rows))


def randomised_svd(rows: DataFrame, v: int, rank: int, seed: int = SEED, normal=_normal, gram=None, more: pd.DataFrame | None = None) -> np.ndarray:
    """Right singular vectors (``v`` by at most ``rank``) of the matrix with sparse ``rows(terms, weights)``.

    Rows of another form come with their own products ``normal`` and ``gram``; ``more`` are sparse rows that the driver holds."""
    gram = gram or (lambda f, b: (t := _times(f, b)).T @ t)
    width = min(v, rank + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((v, width)))[0]
    for _ in range(POWER):
        now = basis
        total = _gathered(rows, width, v, lambda f: normal(f, now))
        basis = np.linalg.qr(total if more is None else total + _normal(more, now))[0]
    total = _gathered(rows, width, width, lambda f: gram(f, basis))
    if more is not None:
        total += (own := _times(more, basis)).T @ own
    values, vectors = np.linalg.eigh(total)
    keep = [i for i in np.argsort(values)[::-1][:rank] if values[i] > 1e-9 * max(values.max(), 1e-12)]
    return basis @ vectors[:, keep]


def _row(terms: np.ndarray, idf: np.ndarray) -> tuple[list[int], list[float]]:
    terms, tf = np.unique(terms, return_counts=True)
    w = tf * idf[terms]
    return terms.tolist(), (w / max(np.linalg.norm(w), 1e-12)).tolist()


def build_space(spark: SparkSession, docs: DataFrame, items: list[Item]) -> Space:
    vocabulary = np.unique(np.concatenate([i.words[a:b] for i in items for a, b in i.passages]))
    v = len(vocabulary)
    corpus = corpus_passages(docs, vocabulary)
    counts, passages = term_counts(corpus, v + 2 * BUCKETS)
    all_idf = np.log((passages + 1.0) / (counts + 1.0)) + 0.05
    counts, idf = counts[:v], all_idf[:v]
    weight = np.append(idf, np.median(idf))
    owner, length, norm, rows = [], [], [], []
    held = np.zeros((v + 1, sum(len(i.passages) for i in items)), np.uint8)
    answered, sieve = np.zeros((v + 1, len(items)), np.uint8), _sieve(vocabulary)
    for n, item in enumerate(items):
        here, times = np.unique(_lookup(item.answer, vocabulary, sieve), return_counts=True)
        answered[here, n] = np.minimum(times, 255)
        for a, b in item.passages:
            terms, tf = np.unique(np.searchsorted(vocabulary, item.words[a:b]), return_counts=True)
            held[terms, len(rows)] = tf
            owner.append(n), length.append(b - a), norm.append(np.linalg.norm(tf * idf[terms]))
            rows.append(_row(np.searchsorted(vocabulary, item.words[a:b]), idf))
    answered[v] = 0
    owner, length, norm, mass = np.array(owner), np.array(length), np.array(norm), idf**2 @ held[:-1]
    telling = np.array([len(i.answer) >= TELLING for i in items])

    products = Corpus(all_idf, v)
    own = pd.DataFrame(rows, columns=["terms", "weights"])
    rank = min(LATENT_RANK, len(rows) + passages)
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-passages // FEW)), -(-passages // MANY))
    latent = randomised_svd(corpus.coalesce(tasks), v + BUCKETS, rank, normal=products.normal, gram=products.gram, more=own)
    release(corpus)
    folds = products.table(latent).astype(np.float32)
    rest = (held[:-1] * (answered[:-1, owner] == 0)).T.astype(np.float32) @ folds[:v]
    rest /= np.maximum(np.linalg.norm(rest, axis=1, keepdims=True), 1e-9)
    return Space(items, owner, length, vocabulary, counts, weight, held, answered, mass, norm, telling, folds, rest)


def _latent_terms(terms: np.ndarray, words: np.ndarray, v: int) -> np.ndarray:
    """Numbers of the words in the latent space: ``terms`` below ``v``, and a bucket with a sign for any other word."""
    return np.where(terms < v, terms, v + (words >> np.uint64(40)).astype(np.int64) % (2 * BUCKETS))


# ---- search and confirmation


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | (1 << i)
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for y in b.tolist():
        if m := masks.get(y):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _places(terms: np.ndarray, bounds: np.ndarray, space: Space, screen: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, first word, passage)`` of blocks of ``COARSE`` words where a window may begin that is a candidate for the passage."""
    lengths, n_passages = np.diff(bounds), len(space.length)
    blocks = -(-lengths // COARSE)
    first_block = np.append(0, np.cumsum(blocks))
    postings, passages, weights = screen
    hit = np.flatnonzero(postings[terms + 1] > postings[terms])
    text = np.searchsorted(bounds, hit, side="right") - 1
    block = first_block[text] + (hit - bounds[text]) // COARSE
    out = []
    for at in range(0, int(first_block[-1]), 2048):
        a, b = np.searchsorted(block, [at, at + 2049])
        begin = postings[terms[hit[a:b]]]
        each = postings[terms[hit[a:b]] + 1] - begin
        which = np.repeat(begin - np.cumsum(each) + each, each) + np.arange(each.sum())
        here = min(2049, int(first_block[-1]) - at)
        sums = np.bincount(np.repeat(block[a:b] - at, each) * n_passages + passages[which], weights[which], here * n_passages).reshape(here, n_passages)
        new = np.zeros(here + 1, bool)
        inside = first_block[(first_block >= at) & (first_block <= at + here)] - at
        new[inside] = True  # a block that begins a text adds nothing to the one before
        both = sums[:2048].copy()
        both[: here - 1] += sums[1:] * ~new[1:here, None]
        i, p = np.nonzero(both >= 1)
        out.append((i + at, p))
    i, p = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
    text = np.searchsorted(first_block, i, side="right") - 1
    return text, bounds[text] + (i - first_block[text]) * COARSE, p


def _candidates(words: np.ndarray, bounds: np.ndarray, space: Space, sieve: np.ndarray, screen: tuple, exact: np.ndarray) -> dict[tuple[int, int], list[tuple]]:
    """By text and item: ``(cosine, passage, start, end, near in the latent space)`` of windows that are candidates for one of its passages."""
    found: dict[tuple[int, int], list[tuple]] = {}
    other = len(space.vocabulary)
    terms = _lookup(words, space.vocabulary, sieve)
    whole = np.concatenate(([0.0], np.cumsum(space.weight[terms] ** 2)))
    places = _places(terms, bounds, space, screen)
    short = space.length[places[2]] < SHORT
    for (size, wide, step), mine in zip(SCALES, (~short, short)):
        for at in range(0, int(mine.sum()), 4096):
            text, begin, passage = (x[mine][at : at + 4096] for x in places)
            end = bounds[text + 1]
            grid = _windows(terms, begin, np.minimum(end, begin + 2 * COARSE), 2 * COARSE, other)
            # windows start every ``step`` words, so their sums are sums of whole blocks
            sums = exact[grid, passage[:, None]].reshape(len(grid), -1, step).sum(axis=2)
            sums = np.append(np.zeros((len(grid), 1)), np.cumsum(sums, axis=1, dtype=np.float64), axis=1)
            starts = begin[:, None] + np.arange(0, COARSE, step)
            for n in (size, wide):
                dots = sums[:, n // step : n // step + starts.shape[1]] - sums[:, : starts.shape[1]]
                # up to the first window that reaches the end
                valid = starts < np.maximum(end - n, bounds[text])[:, None] + step
                ends = np.minimum(starts + n, end[:, None])
                if n == size:
                    # the norm but for words that repeat, which make it larger
                    full = np.sqrt(np.where(valid, whole[ends] - whole[np.minimum(starts, ends)], np.inf))
                    k, j = np.nonzero(valid & (dots >= COSINE * full * (1 - 1e-9)))
                    cosine = dots[k, j] / _norms(terms, starts[k, j], ends[k, j], n, space)
                    near = np.zeros(len(k), bool)
                    good = cosine >= COSINE
                else:
                    # a word that repeats adds to the sum each time, so it is a bound on the weight held
                    k, j = np.nonzero(valid & (dots >= (WEIGHT * space.mass / space.norm)[passage, None] * (1 - 1e-9)))
                    enough, near = _holding(words, terms, starts[k, j], ends[k, j], passage[k], n, space)
                    good = enough | near
                    cosine = np.zeros(len(k))
                    cosine[good] = dots[k, j][good] / _norms(terms, starts[k, j][good], ends[k, j][good], n, space)
                k, j, cosine, near = k[good], j[good], cosine[good], near[good]
                rows = zip(text[k].tolist(), cosine.tolist(), passage[k].tolist(), starts[k, j].tolist(), ends[k, j].tolist(), near.tolist())
                for t, c, p, a, b, close in rows:
                    found.setdefault((t, int(space.owner[p])), []).append((c, p, a, b, close))
    return found


def _windows(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int, other: int) -> np.ndarray:
    grid = starts[:, None] + np.arange(size)
    return np.where(grid < ends[:, None], terms[np.minimum(grid, len(terms) - 1)], other)


def _norms(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int, space: Space) -> np.ndarray:
    """Norms of windows, other words counted as different from each other."""
    other, out = len(space.vocabulary), np.zeros(len(starts))
    for at in range(0, len(starts), 512):
        a, b = starts[at : at + 512], ends[at : at + 512]
        words = _windows(terms, a, b, size, other)
        times = np.where(words < other, (words[:, :, None] == words[:, None, :]).sum(axis=2), 1)
        inside = np.arange(size) < (b - a)[:, None]
        out[at : at + 512] = np.sqrt((space.weight[words] ** 2 * times * inside).sum(axis=1))
    return out


def _holding(words, terms, starts, ends, passages, wide, space) -> tuple[np.ndarray, np.ndarray]:
    """Which windows hold enough of their passage's words, and which hold its answer and are near it in the latent space; both hold enough of its weight."""
    enough, near = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    other = len(space.vocabulary)
    for at in range(0, len(starts), 4096):
        passage = passages[at : at + 4096]
        each = _windows(terms, starts[at : at + 4096], ends[at : at + 4096], wide, other)
        each.sort(axis=1)
        each[:, 1:][each[:, 1:] == each[:, :-1]] = other
        held = space.held[each, passage[:, None]]
        heavy = (held * space.weight[each] ** 2).sum(axis=1) >= WEIGHT * space.mass[passage]
        enough[at : at + 4096] = heavy & (held.sum(axis=1, dtype=np.int64) >= PARAPHRASE * space.length[passage])
        answers = space.answered[each, space.owner[passage][:, None]]
        told = ((answers > 0) * held * space.weight[each] ** 2).sum(axis=1) >= WEIGHT * space.mass[passage]
        told &= space.telling[space.owner[passage]]
        least = TOLD * np.array([len(i.answer) for i in space.items])[space.owner[passage]]
        for k in np.flatnonzero(told & (answers.sum(axis=1, dtype=np.int64) >= least)):
            near[at + k] = _latent_cosine(words, terms, starts[at + k], ends[at + k], passage[k], space) >= LATENT
    return enough, near


def _latent_cosine(words, terms, start, end, passage, space) -> float:
    """Largest latent cosine with the rest of a passage, without the answer's words, of parts of a window that are as long as one."""
    size, _, step = SCALES[int(space.length[passage] < SHORT)]
    best = 0.0
    for a in range(start, max(start, end - size) + 1, step):
        t, w = terms[a : min(a + size, end)], words[a : min(a + size, end)]
        rest = space.answered[t, space.owner[passage]] == 0
        row = space.folds[_latent_terms(t[rest], w[rest], len(space.vocabulary))].sum(axis=0)
        best = max(best, float(row @ space.rest[passage]) / max(float(np.linalg.norm(row)), 1e-9))
    return best


def _confirmed(words: np.ndarray, item: Item, near: list[tuple], first: np.ndarray) -> tuple[float, float, bool] | None:
    """``(cosine, share of the item, answer found)`` of the best place that holds the item, or None."""
    n, tried = len(item.words), set()
    for cosine, passage, start, end, close in sorted(near, reverse=True):
        lo, hi = max(0, start - n), min(len(words), end + n)
        if (lo // 8, passage, close) in tried:
            continue
        tried.add((lo // 8, passage, close))
        region = words[lo:hi]
        share = common_subsequence(item.words, region) / n
        answer = common_subsequence(item.answer, region) >= ANSWER * len(item.answer)
        close = close and common_subsequence(item.answer, words[start:end]) >= TOLD * len(item.answer)
        a, b = item.passages[passage - first[passage]]
        part = item.words[a:b]
        if (
            share >= WHOLE
            or ((share >= PARAPHRASE or close) and answer)
            or (len(part) >= LONG_PASSAGE and common_subsequence(part, words[max(0, start - STEP) : end + STEP]) >= PART * len(part))
        ):
            return cosine, share, answer
    return None


ITEM = "__item"
LEAKS = f"doc_id long, {FILE_KEY} long, {ROW_KEY} long, item_id long, cosine double, lcs_share double, answer_found boolean"


def _search(keyed: DataFrame, space: Space) -> DataFrame:
    #: number of an item's first passage, by passage
    first = np.searchsorted(space.owner, space.owner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, screen = _sieve(space.vocabulary), space.screen()
        exact = (space.held * (space.weight**2)[:, None] / space.norm).astype(np.float32)
        for batch in batches:
            rows = []
            for before, words, bounds in grouped(batch.column("text")):
                for (text, n), near in _candidates(words, bounds, space, sieve, screen, exact).items():
                    a, b = int(bounds[text]), int(bounds[text + 1])
                    item = space.items[n]
                    if b - a >= LEAST_WORDS and (leak := _confirmed(words[a:b], item, [(c, p, s - a, e - a, k) for c, p, s, e, k in near], first)):
                        key = (batch.column(c)[before + text].as_py() for c in ("doc_id", FILE_KEY, ROW_KEY))
                        rows.append((*key, item.item_id, *leak, item.number))
            types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.bool_(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * len(types)
            names = ["doc_id", FILE_KEY, ROW_KEY, "item_id", "cosine", "lcs_share", "answer_found", ITEM]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return keyed.select(F.col("doc_id").cast("long").alias("doc_id"), FILE_KEY, ROW_KEY, "text").mapInArrow(run, f"{LEAKS}, {ITEM} long")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``LEAKS`` rows: which document of ``docs(doc_id, text)`` holds which item of ``benchmark(item_id, text)``."""
    spark = docs.sparkSession
    keyed = with_row_key(docs)
    ordered = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = spark.createDataFrame([], f"{LEAKS}, {ITEM} long")
    split = False
    for block in _blocks(_items(ordered)):
        found = found.unionByName(materialize(_search(keyed, build_space(spark, docs, block)), "leaks"))
        split = split or len(block[0].passages) < block[0].cut
    if split:  # an item that was searched in several blocks is reported once
        columns = [c for c in found.columns if c not in (FILE_KEY, ROW_KEY, ITEM)]
        best = F.max_by(F.struct(*columns), F.struct("lcs_share", "cosine")).alias("best")
        found = found.groupBy(FILE_KEY, ROW_KEY, ITEM).agg(best).select("best.*", FILE_KEY, ROW_KEY)
    return found.select("doc_id", FILE_KEY, ROW_KEY, "item_id", "cosine", "lcs_share", "answer_found")


def _items(ordered: DataFrame) -> Iterator[Item]:
    for number, row in enumerate(ordered.orderBy("item_id", "text").toLocalIterator()):
        item = _item(row["item_id"], row["text"])
        if len(item.words) >= LEAST_WORDS:
            yield replace(item, number=number, cut=len(item.passages))


def _blocks(items: Iterator[Item]) -> Iterator[list[Item]]:
    """Items in blocks of at most ``RANK`` passages; the benchmark comes to the driver one block at a time."""
    block, passages = [], 0
    for item in items:
        if block and passages + len(item.passages) > RANK:
            yield block
            block, passages = [], 0
        if len(item.passages) > RANK:
            for at in range(0, len(item.passages), RANK):
                yield [replace(item, passages=item.passages[at : at + RANK])]
        else:
            block.append(item)
            passages += len(item.passages)
    if block:
        yield block


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "cosine", "lcs_share", "answer_found")
