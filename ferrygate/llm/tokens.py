"""Token counts of whole texts: pieces are counted once per distinct pre-token and joined to frequencies.

Tasks turn blocks of documents into an inverted index: per distinct pre-token (a run without ASCII white space) the documents of the
block that have it and how often. The index is dealt by pre-token. The task that receives a pre-token asks the
tokenizer once for its number of pieces, multiplies it with the frequencies and adds up per document; partial sums meet by
block. No token ids are kept anywhere, and texts are never shuffled.

A pre-token is a safe unit: the vocabulary's normaliser, its special strings and its splitting never reach across white
space, and white space makes no tokens (``tests/llm`` holds this against whole texts).

A pre-token that an eighth of a block's documents share is dealt by block as well, so a very common one is
counted in several tasks instead of filling one. Long texts are cut at white space into pieces of about ``PIECE`` bytes.

Defined cases: a null text has 0 bytes and 0 tokens; repeated rows and null ids give a row each; an empty table
gives no rows. The scan must give the same rows in the same order when a task is repeated, as file scans do.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import table

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
BLOCK_DOCS, PIECE = 2000, 4 << 20
#: Pre-tokens whose counts a task remembers at a time.
REMEMBERED = 1_000_000
COMMON_SHARE = 8

INDEX = "base long, docs int, bucket int, doc_id long, n_bytes long, words array<binary>, holders array<int>, places binary, times binary"


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` cut at ASCII white space into pieces of about ``PIECE`` bytes."""
    at = 0
    while len(raw) - at > PIECE:
        cut = max(raw.rfind(blank, at, at + PIECE) for blank in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:  # one run without white space is longer than a piece
            ends = [e for e in (raw.find(b, at + PIECE) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if e >= 0]
            cut = min(ends, default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def _index_block(base: int, lists: list[tuple[int, list[bytes]]], docs: int, buckets: int) -> dict[str, list]:
    """Index rows of one block, one per bucket: words, how many documents hold each, which, and how often."""
    words = [w for _, found in lists for w in found]
    out = {"bucket": [], "words": [], "holders": [], "places": [], "times": []}
    if not words:
        return out
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    owner = np.repeat([place for place, _ in lists], [len(found) for _, found in lists])
    pairs, times = np.unique(codes * np.int64(docs) + owner, return_counts=True)
    word, place = pairs // docs, pairs % docs
    holders = np.bincount(word, minlength=len(distinct))
    hashes = pd.util.hash_array(distinct, categorize=False)
    spread = np.where(holders * COMMON_SHARE > docs, np.uint64((base // BLOCK_DOCS) & 0xFFFFFF), np.uint64(0))
    bucket = ((hashes + spread) % np.uint64(buckets)).astype(np.int64)
    # a count above 255 becomes several entries
    repeats = (times + 254) // 255
    word, place = np.repeat(word, repeats), np.repeat(place, repeats)
    last = np.cumsum(repeats) - 1
    split = np.full(len(word), 255)
    split[last] = times - 255 * (repeats - 1)
    holders = np.bincount(word, minlength=len(distinct))
    order = np.argsort(bucket, kind="stable")
    of_word = np.empty(len(distinct), np.int64)
    of_word[order] = np.arange(len(distinct))
    by_bucket = np.argsort(of_word[word], kind="stable")
    place, split = place[by_bucket].astype(np.uint16), split[by_bucket].astype(np.uint8)
    ends = np.concatenate(([0], np.cumsum(holders[order])))
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        out["bucket"].append(int(bucket[order[a]]))
        out["words"].append(distinct[order[a:b]].tolist())
        out["holders"].append(holders[order[a:b]].astype(np.int32))
        out["places"].append(place[ends[a] : ends[b]].tobytes())
        out["times"].append(split[ends[a] : ends[b]].tobytes())
    return out


def index_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """The inverted index of ``docs(doc_id, text)`` in blocks, and one row per document with its id and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("base", pa.int64()),
                ("docs", pa.int32()),
                ("bucket", pa.int32()),
                ("doc_id", pa.int64()),
                ("n_bytes", pa.int64()),
                ("words", pa.list_(pa.binary())),
                ("holders", pa.list_(pa.int32())),
                ("places", pa.binary()),
                ("times", pa.binary()),
            ]
        )
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            lists, size, base = [], 0, number

            def flush(upto: int) -> pa.RecordBatch:
                rows = _index_block(base, lists, upto - base + 1, buckets)
                n = len(rows["bucket"])
                return pa.RecordBatch.from_pydict(
                    {"base": [base] * n, "docs": [upto - base + 1] * n, "doc_id": [None] * n, "n_bytes": [None] * n, **rows}, schema=schema
                )

            sizes = []
            for text in texts:
                raw = (text.as_py() or "").encode("utf-8", "replace")
                sizes.append(len(raw))
                for piece in _pieces(raw):
                    lists.append((number - base, piece.split()))
                    size += len(piece)
                    if size >= PIECE or number - base >= BLOCK_DOCS - 1:
                        yield flush(number)
                        lists, size, base = [], 0, number
                number += 1
            yield flush(number)
            n = len(ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "base": list(range(number - n, number)),
                    "docs": [0] * n,
                    "bucket": [i % buckets for i in range(n)],
                    "doc_id": ids,
                    "n_bytes": sizes,
                    **{c: [None] * n for c in ("words", "holders", "places", "times")},
                },
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def count_pieces(index: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(base, totals, doc_id, n_bytes)``: partial token totals of a block's documents; document rows pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer, known = Tokenizer.from_file(tokenizer_path), {}
        for batch in batches:
            base, docs = batch.column("base").to_pylist(), batch.column("docs").to_pylist()
            places, times, words, holders = (batch.column(c) for c in ("places", "times", "words", "holders"))
            totals = []
            for i, n in enumerate(docs):
                if not n:
                    totals.append(None)
                    continue
                mine = words[i].as_py()
                new = [w for w in mine if w not in known]
                if len(known) + len(new) > REMEMBERED:
                    known, new = {}, mine
                for at in range(0, len(new), 4096):
                    part = new[at : at + 4096]
                    coded = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
                    known.update(zip(part, map(len, coded)))
                per_word = np.array([known[w] for w in mine], np.int64)
                per_entry = np.repeat(per_word, holders[i].values.to_numpy(zero_copy_only=False))
                per_entry *= np.frombuffer(times[i].as_py(), np.uint8)
                totals.append(np.bincount(np.frombuffer(places[i].as_py(), np.uint16), per_entry, n).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("base"), pa.array(totals, pa.list_(pa.int64())), batch.column("doc_id"), batch.column("n_bytes")],
                names=["base", "totals", "doc_id", "n_bytes"],
            )

    return index.mapInArrow(run, "base long, totals array<long>, doc_id long, n_bytes long")


def _sum_block(rows: pd.DataFrame) -> pd.DataFrame:
    base, n = int(rows["base"].iloc[0]), max(map(len, rows["totals"]))
    total = np.zeros(n, np.int64)
    for one in rows["totals"]:
        total[: len(one)] += one
    return pd.DataFrame({"number": np.arange(base, base + n), "tokens": total})


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row of ``docs(doc_id, text)``."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = index_texts(docs, buckets)
    partial = count_pieces(index.repartition("bucket"), tokenizer_path)
    partial = materialize(partial, "token-partials")
    sums = partial.filter("totals is not null").select("base", "totals").groupBy("base").applyInPandas(_sum_block, "number long, tokens long")
    rows = partial.filter("totals is null").select(F.col("base").alias("number"), "doc_id", "n_bytes")
    return (
        rows.join(sums.groupBy("number").agg(F.sum("tokens").alias("tokens")), "number", "left")
        .select("doc_id", "n_bytes", F.coalesce("tokens", F.lit(0)).alias("n_tokens"))
    )


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counted = token_counts(table(spark, sf_dir, "documents"), tokenizer_file())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
