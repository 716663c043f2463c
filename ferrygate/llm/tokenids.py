"""Token ids of whole texts as binary shards, with a minimal perfect hash index from document keys to places.

Texts are dealt by ranges of their id and encoded in the task that writes them, in ascending order, so ids are never shuffled. A task
streams ids into a payload file and closes it at ``FILE_BYTES``; beside each payload lies its index.

* ``ids-<part>-<number>.bin``: the ids of all documents one after the other, little-endian, two bytes each where the vocabulary
  allows it and four otherwise.
* ``ids-<part>-<number>.idx``: the magic, eight header numbers, the levels and bits of a minimal perfect hash over the distinct
  keys, then by slot the key's 64-bit fingerprint, its first document and how many it has, then by document the end of its ids, then the
  keys in order. A key that is not in the file falls on some slot and is told by its fingerprint.
* ``_manifest``: Parquet rows of the files that were committed, with their first and last key, counts and digests.

A keyed read asks the manifest for the files whose range holds the key (more than one only if its documents span files), hashes
the key once per file and reads the one span of ids it names. Files are committed like archives: an attempt writes
names of its own, Spark keeps the manifest rows of the attempts that succeeded, and exactly those files are moved.

Encoding remembers what it has seen. A text is cut before each space that follows no white space, where byte-level splitting never
reaches across; a piece seen before is a dictionary read, a new one is the word it begins with, mostly seen before too, and a rest that is
split as the vocabulary's own rule has it; only unknown pre-tokens go through the vocabulary's merges. Texts with special strings, and texts of vocabularies with another rule, are encoded whole.

Defined cases: a null text is empty and has the end id alone; rows with a null id come first and are reached by the key
``None``; documents with equal ids lie side by side in the order of their texts' hashes, and the key names them all; an empty
table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..filesystem import remove_folder
from ..session import scratch_dir
from .common import table
from .mph import MinimalPerfectHash, mixed
from .ordered import batches_of, in_ranges, rows_of
from .tokens import tokenizer_file
from .warc import file_system

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
FILE_BYTES = 64 << 20
#: Pieces whose ids a worker remembers, and four times the other pre-tokens: at most twice as many, the older half goes.
REMEMBERED = 640_000
MAGIC = b"IDXIDS01"
HEADER = ["width", "docs", "ids", "keys", "nulls", "levels", "bits", "reserved"]

MANIFEST = (
    "part int, number int, temporary string, name string, first_key long, last_key long, nulls long, docs long, ids long, "
    "n_bytes long, index_bytes long, sha256 string"
)


# ---- encoding

#: The split rule of byte-level vocabularies for ASCII and Latin letters up to U+024F; other texts are split by the library.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(f"[\x00-\x7f{_LETTER}]*")
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^ \t\n\r\f\v{_LETTER}0-9]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+"
)
_STEM = re.compile(f"[{_LETTER}]+")
_CUT = re.compile(r"(?<=\S) ")


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Remembered:
    """A map of bounded size: when it is full its older half goes, and what is read from that half meanwhile stays."""

    def __init__(self, most: int):
        self.most, self.now, self.old = most, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.now.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> bytes:
        if len(self.now) >= self.most:
            self.now, self.old = {}, self.now
        self.now[key] = value
        return value


class Encoder:
    """Ids of texts as packed bytes, equal to the library's over whole texts."""

    def __init__(self, tokenizer_path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.pieces, self.parts = Remembered(remembered), Remembered(max(1, remembered // 4))
        self.tokenize = self.tokenizer.model.tokenize
        #: What each id looks like in a payload.
        self.packed = [i.to_bytes(self.width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.letters = _byte_letters()
        self.space = chr(self.letters[0x20])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_pieces = (
            isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
            and self.tokenizer.normalizer is None
            and not self.tokenizer.pre_tokenizer.add_prefix_space
            and not any(" " in t for t in self.special)
        )

    def _packed(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.packed.__getitem__, ids))

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _merged(self, part: str) -> bytes:
        """Ids of one pre-token, through the merges."""
        if part.isascii() and part[1:].isalnum() and (part[0] == " " or part[0].isalnum()):
            written = self.space + part[1:] if part[0] == " " else part
        else:
            written = part.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.tokenize(written)])

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        return self.parts.put(part, self._merged(part)) if found is None else found

    def _parts(self, text: str) -> bytes:
        return b"".join(map(self._part, _SPLIT.findall(text)))

    def piece(self, text: str) -> bytes:
        return self._parts(text) if text.isascii() or _PLAIN.fullmatch(text) else self._whole(text)

    def _word(self, word: str) -> bytes:
        """``piece(" " + word)``: the letters that a word begins with are a pre-token, and remembered as the word they are."""
        found = self.pieces.get(word)
        if found is not None:
            return found
        stem = _STEM.match(word)
        if stem is None:
            found = self.piece(" " + word)
        elif stem.end() == len(word):
            if word.isascii():
                found = b"".join([self.packed[t.id] for t in self.tokenize(self.space + word)])
            else:
                found = self._merged(" " + word)
        else:
            tail = word[stem.end() :]
            if not (tail.isascii() or _PLAIN.fullmatch(tail)):
                found = self._whole(" " + word)
            else:
                found = self._word(stem[0]) + (self._part(tail) if len(tail) == 1 else self._parts(tail))
                if "\n" in tail:  # two words with a line's end between them seldom meet again
                    return found
        # what white space at the end gives depends on what follows
        return self.pieces.put(word, found) if word and not word[-1].isspace() else found

    def encode(self, text: str) -> bytes:
        if not self.by_pieces or any(t in text for t in self.special):
            return self._whole(text)
        first, *rest = text.split(" ")
        out = list(map(self.pieces.now.get, rest))
        if rest and first[-1:].isspace():
            return self._cut(text)
        at, last = -1, len(rest) - 1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            word = rest[at]
            if at < last and (not word or word[-1].isspace()):
                return self._cut(text)
            out[at] = self._word(word)
        return (self.piece(first) if first else b"") + b"".join(out)

    def _cut(self, text: str) -> bytes:
        """For texts where a space follows white space: these are not cut."""
        first, *rest = _CUT.split(text)
        return (self.piece(first) if first else b"") + b"".join(map(self._word, rest))


def worker_encoder(tokenizer_path: str) -> Encoder:
    """The encoder of this Python worker: it stays between tasks, so what one has learnt serves the next."""
    held = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders")).__dict__
    if tokenizer_path not in held:
        held[tokenizer_path] = Encoder(tokenizer_path)
    return held[tokenizer_path]


# ---- index


def key_hash(keys: np.ndarray) -> np.ndarray:
    return mixed(np.asarray(keys, np.int64).view(np.uint64), 101)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return mixed(np.asarray(keys, np.int64).view(np.uint64), 202)


def pack_index(keys: list[int | None], ends: np.ndarray, width: int) -> bytes:
    """The index of documents in order, from their ascending keys (nulls first) and the ends of their ids."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first, runs = np.unique(known, return_index=True, return_counts=True)
    hashing = MinimalPerfectHash.build(key_hash(distinct))
    slots = hashing.slots(key_hash(distinct))
    if not np.array_equal(np.sort(slots), np.arange(len(distinct))):
        raise ValueError("the keys' slots are not one each")
    prints, firsts, counts = np.zeros(len(distinct), "<u8"), np.zeros(len(distinct), "<i8"), np.zeros(len(distinct), "<i8")
    prints[slots], firsts[slots], counts[slots] = fingerprints(distinct), first + nulls, runs
    ids = int(ends[-1]) if len(ends) else 0
    header = np.array([width, len(keys), ids, len(distinct), nulls, len(hashing.sizes), len(hashing.bits), 0], "<i8")
    all_keys = np.concatenate((np.zeros(nulls, np.int64), known)).astype("<i8")
    arrays = [header, hashing.sizes.astype("<i8")]
    return MAGIC + b"".join(a.tobytes() for a in arrays) + hashing.bits + b"".join(
        a.tobytes() for a in (prints, firsts, counts, np.asarray(ends, "<i8"), all_keys)
    )


class Index:
    """A file's index: constant-time places of keys."""

    def __init__(self, raw: bytes):
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("no index of token ids")
        at = len(MAGIC)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += found.nbytes
            return found

        self.header = dict(zip(HEADER, take("<i8", len(HEADER)).tolist()))
        sizes = take("<i8", self.header["levels"])
        bits = raw[at : at + self.header["bits"]]
        at += len(bits)
        self.hashing = MinimalPerfectHash(sizes, bits)
        n, docs = self.header["keys"], self.header["docs"]
        self.prints, self.firsts, self.counts = take("<u8", n), take("<i8", n), take("<i8", n)
        self.ends, self.keys = take("<i8", docs), take("<i8", docs)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first document, documents)`` of every key; 0 documents where the fingerprint tells that the file has none."""
        slots = self.hashing.slots(key_hash(keys))
        held = slots >= 0
        held[held] = self.prints[slots[held]] == fingerprints(keys)[held]
        first, count = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
        first[held], count[held] = self.firsts[slots[held]], self.counts[slots[held]]
        return first, count

    def span(self, doc: int) -> tuple[int, int]:
        """Where the ids of a document begin and end."""
        return (int(self.ends[doc - 1]) if doc else 0), int(self.ends[doc])


# ---- writer


def write_token_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of ``docs(doc_id, text)`` below ``folder``, which must be new."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        files, target = file_system(folder)
        part, attempt = TaskContext.get().partitionId(), f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        files.create_dir(f"{target}/_temporary", recursive=True)
        end = np.array([end_id], encoder.kind).tobytes()

        def close(number: int, stream, name: str, keys: list, ends: list, digest) -> tuple:
            stream.close()
            index = pack_index(keys, np.array(ends, np.int64), encoder.width)
            with files.open_output_stream(f"{target}/{name}.idx", compression=None) as out:
                out.write(index)
            nulls = sum(k is None for k in keys)
            first = keys[nulls] if nulls < len(keys) else None
            return (
                part, number, name, f"ids-{part:06d}-{number:04d}", first, keys[-1], nulls, len(keys), ends[-1],
                ends[-1] * encoder.width, len(index), digest.hexdigest(),
            )

        def written() -> Iterator[tuple]:
            number, held = 0, None
            for key, text in rows_of(batches):
                if held is None:
                    name = f"_temporary/{attempt}-{number:04d}"
                    held = (files.open_output_stream(f"{target}/{name}.bin", compression=None), name, [], [], hashlib.sha256())
                stream, name, keys, ends, digest = held
                raw = encoder.encode(text or "") + end
                stream.write(raw)
                digest.update(raw)
                keys.append(key)
                ends.append((ends[-1] if ends else 0) + len(raw) // encoder.width)
                if ends[-1] * encoder.width >= file_bytes:
                    yield close(number, *held)
                    number, held = number + 1, None
            if held is not None:
                yield close(number, *held)

        schema = pa.schema(
            [
                ("part", pa.int32()),
                ("number", pa.int32()),
                ("temporary", pa.string()),
                ("name", pa.string()),
                ("first_key", pa.int64()),
                ("last_key", pa.int64()),
                ("nulls", pa.int64()),
                ("docs", pa.int64()),
                ("ids", pa.int64()),
                ("n_bytes", pa.int64()),
                ("index_bytes", pa.int64()),
                ("sha256", pa.string()),
            ]
        )
        yield from batches_of(written(), schema)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    in_ranges(keyed, "doc_id", "tie").drop("tie").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    _commit(spark, folder)


def _commit(spark: SparkSession, folder: str) -> None:
    """Move the listed files to their final names; may be repeated."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, target = file_system(folder)
        for batch in batches:
            for name, temporary, n_bytes, index_bytes in zip(*(c.to_pylist() for c in batch.columns)):
                for suffix, size in ((".bin", n_bytes), (".idx", index_bytes)):
                    there, final = f"{target}/{temporary}{suffix}", f"{target}/{name}{suffix}"
                    if files.get_file_info(there).type != fs.FileType.NotFound:
                        files.move(there, final)
                    elif files.get_file_info(final).size != size:
                        raise FileNotFoundError(final)
            yield batch.select(["n_bytes"])

    manifest(spark, folder).select("name", "temporary", "n_bytes", "index_bytes").mapInArrow(move, "n_bytes long").agg(F.sum("n_bytes")).collect()
    remove_folder(spark, f"{folder}/_temporary")


# ---- readers


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _open(files, target: str, name: str) -> Index:
    with files.open_input_stream(f"{target}/{name}.idx", compression=None) as stream:
        return Index(stream.read())


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _crc(raw: bytes, width: int) -> int:
    return zlib.crc32(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every stored document: each file's keys go through its index, ``start`` counts the ids before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, target = file_system(folder)

        def walk() -> Iterator[tuple]:
            for name, sha256, before in rows_of(batches):
                index = _open(files, target, name)
                with files.open_input_stream(f"{target}/{name}.bin", compression=None) as stream:
                    payload = stream.read()
                if hashlib.sha256(payload).hexdigest() != sha256:
                    raise ValueError(f"{name}.bin does not match its digest")
                width, nulls = index.header["width"], index.header["nulls"]
                distinct = np.unique(index.keys[nulls:])
                first, count = index.lookup(distinct)
                if int(count.sum()) + nulls != index.header["docs"]:
                    raise ValueError(f"{name}.idx does not reach all its documents")
                found = [(None, 0, nulls)] if nulls else []
                for key, at, n in [*found, *zip(distinct.tolist(), first.tolist(), count.tolist())]:
                    for doc in range(at, at + n):
                        begin, end = index.span(doc)
                        yield key, before + begin, end - begin, _crc(payload[begin * width : end * width], width)

        yield from batches_of(walk(), READ)

    # a window over one row per file
    before = (F.sum("ids").over(Window.orderBy("part", "number")) - F.col("ids")).alias("before")
    listed = manifest(spark, folder).select("name", "sha256", before)
    return listed.repartition(4 * spark.sparkContext.defaultParallelism, "name").mapInArrow(run, READ_DDL)


def fetch(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``(doc_id, doc, ids)`` of the stored documents of ``keys(doc_id)``, by keyed access; keys that are not stored give no row.

    Tasks deal the keys by the ranges in the manifest, which holds one short row per file, then read only the spans of their keys.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        files, target = file_system(folder)
        listed = pq.read_table(f"{target}/_manifest", filesystem=files, columns=["part", "number", "name", "first_key", "last_key", "nulls"])
        rows = sorted(listed.to_pylist(), key=lambda r: (r["part"], r["number"]))
        with_nulls = [r["name"] for r in rows if r["nulls"]]
        keyed = [r for r in rows if r["first_key"] is not None]
        first, last = (np.array([r[c] for r in keyed], np.int64) for c in ("first_key", "last_key"))

        def walk() -> Iterator[tuple]:
            for (key,) in rows_of(batches):
                if key is None:
                    yield from ((name, None) for name in with_nulls)
                else:
                    for i in range(int(np.searchsorted(last, key)), int(np.searchsorted(first, key, side="right"))):
                        yield keyed[i]["name"], key

        yield from batches_of(walk(), pa.schema([("name", pa.string()), ("doc_id", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, target = file_system(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("ids", pa.list_(pa.int64()))])

        def walk() -> Iterator[tuple]:
            opened, index, payload = None, None, None
            for name, key in rows_of(batches):
                if name != opened:
                    if payload is not None:
                        payload.close()
                    opened, index, payload = name, _open(files, target, name), files.open_input_file(f"{target}/{name}.bin")
                at, n = (0, index.header["nulls"]) if key is None else (int(x[0]) for x in index.lookup(np.array([key], np.int64)))
                for doc in range(at, at + n):
                    begin, end = index.span(doc)
                    width = index.header["width"]
                    raw = payload.read_at((end - begin) * width, begin * width)
                    yield key, doc, np.frombuffer(raw, f"<u{width}").astype(np.int64)
            if payload is not None:
                payload.close()

        yield from batches_of(walk(), schema, size=lambda row: 8 * len(row[2]))

    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    dealt = wanted.mapInArrow(deal, "name string, doc_id long")
    return dealt.repartition("name").sortWithinPartitions("name", "doc_id").mapInArrow(read, "doc_id long, doc long, ids array<long>")


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into binary shards and read every one back through the index."""
    folder = scratch_dir(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), folder, tokenizer_file(TOKENIZER))
    return read_documents(spark, folder)
