"""Streams of rows in task order: helpers for operators that walk sorted partitions with bounded memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of text that one output batch may hold.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in ascending order of ``keys`` (nulls first), dealt by ranges: a long run of one leading key spans partitions."""
    return df.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys)).sortWithinPartitions(
        *(F.col(k).asc_nulls_first() for k in keys)
    )


def by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """All rows of a key in one partition, in order: for streams that have to see them one after the other."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size=lambda row: 64) -> Iterator[pa.RecordBatch]:
    """``rows`` as batches of bounded length and, by ``size``, of bounded bytes."""
    held, n_bytes = [], 0
    for row in rows:
        held.append(row)
        n_bytes += size(row)
        if len(held) >= BATCH_ROWS or n_bytes >= BATCH_BYTES:
            yield _batch(held, schema)
            held, n_bytes = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def digest_of_pieces(pieces: DataFrame, key: str, order: list[str], text: str, separator: str) -> DataFrame:
    """``(key, digest)``: SHA-256 of the texts of a key in order, joined; nulls add nothing. Streams, so a long key needs no memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(key, pa.string()), ("digest", pa.string())])

        def walk() -> Iterator[tuple]:
            current, found, begun = None, hashlib.sha256(), False
            for row in rows_of(batches):
                if row[0] != current:
                    if current is not None:
                        yield current, found.hexdigest()
                    current, found, begun = row[0], hashlib.sha256(), False
                if row[-1] is not None:
                    found.update(((separator if begun else "") + row[-1]).encode("utf-8", "replace"))
                    begun = True
            if current is not None:
                yield current, found.hexdigest()

        yield from batches_of(walk(), schema)

    return by_key(pieces.select(key, *order, text), key, *order).mapInArrow(run, f"{key} string, digest string")
