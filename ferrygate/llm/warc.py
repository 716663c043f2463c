"""WARC archives: a deterministic sharded writer and a reader, over any folder that pyarrow's file systems reach.

Writing: pages are dealt by ranges of their id into shards of about ``SHARD_BYTES`` payload bytes. The ranges come from exact
byte sums over equal-width bins of the id, narrowed where a bin is too full, so they depend on the rows alone and not on how the scan
was split. Each task sorts its shard by id and writes one compressed gzip member per record, rolling to a new file at ``FILE_BYTES``
compressed bytes. HTTP headers, content lengths, record ids and digests are made anew from the payload; equal rows
give equal bytes on every run.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the largest page id is the response and the
others are revisits that carry headers only. Which is which comes from an aggregate of digests; the small table of decisions travels
in one shuffle with the pages and is sorted ahead of the page it is about, so payloads are shuffled once.

Committing: an attempt writes under names of its own below ``_temporary``; Spark's committer keeps the manifest rows of the attempts that
succeeded, a second job moves exactly those files to their final names (again if repeated), and the manifest
below ``_manifest`` is the list that readers follow. What lost attempts left behind is never listed.

Defined cases: a null html is an empty payload; a null url is an empty target; a null page id sorts first and
loses against any id; of repeated rows one is the response; an empty table gives an empty manifest; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..filesystem import remove_folder
from ..session import materialize, scratch_dir
from .common import table

SHARD_BYTES, FILE_BYTES = 16 << 20, 4 << 20
LEAST_REVISIT = 1000
BINS = 1024
DATE = "2020-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "shard int, part int, temporary string, name string, records long, n_bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def file_system(uri: str):
    """``(file system, path)`` of a folder; Spark's names of some stores are mapped to pyarrow's."""
    from pyarrow import fs

    for spark_name, name in (("s3a://", "s3://"), ("file:///", "/"), ("file:/", "/")):
        if uri.startswith(spark_name):
            uri = name + uri[len(spark_name) :]
            break
    return fs.FileSystem.from_uri(uri)


# ---- ranges of ids


def shard_starts(sizes: DataFrame, target: int) -> np.ndarray:
    """Smallest ids of the shards after the first, from ``sizes(page_id, n_bytes)``; nulls belong to the first shard.

    Each round sums bytes over ``BINS`` equal-width bins of the ranges that are still too full. What the driver sees is one number per
    non-empty bin: at most ``BINS`` times the number of full ranges, itself at most total bytes over ``target``.
    """
    ids = sizes.filter("page_id is not null")
    ends = ids.agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).first()
    if ends["lo"] is None:
        return np.zeros(0, np.int64)
    width = -(-(ends["hi"] - ends["lo"] + 1) // BINS)
    ranges, leaves = ids.select("page_id", "n_bytes", F.lit(ends["lo"]).alias("lo")), []
    while ranges is not None:
        start = F.col("lo") + F.floor((F.col("page_id") - F.col("lo")) / F.lit(width)) * F.lit(width)
        binned = ranges.select("page_id", "n_bytes", start.alias("lo"))
        bins = binned.groupBy("lo").agg(F.sum("n_bytes").alias("n_bytes")).collect()
        full = [b["lo"] for b in bins if b["n_bytes"] > target and width > 1]
        leaves += [(b["lo"], b["n_bytes"]) for b in bins if b["n_bytes"] <= target or width == 1]
        width = max(1, -(-width // BINS))
        # at most total bytes over target rows
        ranges = binned.join(F.broadcast(ids.sparkSession.createDataFrame([(lo,) for lo in full], "lo long")), "lo") if full else None
    starts, held = [], 0
    for start, n_bytes in sorted(leaves):
        if held and held + n_bytes > target:
            starts.append(start)
            held = 0
        held += n_bytes
    return np.array(starts, np.int64)


# ---- records


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; digests are SHA-1 in base 32, as the format has them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    as_base32 = lambda raw: base64.b32encode(raw).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{as_base32(bytes.fromhex(digest))}",
        f"WARC-Block-Digest: sha1:{as_base32(hashlib.sha1(block).digest())}",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {'' if refers_to is None else refers_to}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # no file name, no time
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes) -> tuple:
    """The ``RECORD`` row of one record; digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if hashlib.sha1(block).digest() != base64.b32decode(fields["WARC-Block-Digest"][5:]):
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not match")
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    number = lambda text: int(text) if text else None
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != n_bytes or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    refers_to = number(fields["Refers-To-Page-ID"]) if revisit else None
    return number(fields["Page-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], n_bytes, digest, refers_to, None if revisit else payload


# ---- writer


def _write_shards(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        files, target = file_system(folder)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        files.create_dir(f"{target}/_temporary", recursive=True)
        out, done = None, []
        shard, part, decision, answered = None, 0, None, None

        def close() -> None:
            nonlocal out
            if out is not None:
                out[0].close()
                done.append((shard, part, out[1], f"shard-{shard:06d}-{part:04d}.warc.gz", out[2], out[3], out[4].hexdigest()))
                out = None

        for batch in batches:
            for of, page_id, digest, is_decision, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if of != shard:
                    close()
                    shard, part = of, 0
                key = (page_id, digest)
                if is_decision:
                    decision = (key, refers_to)
                    continue
                payload = (html or "").encode("utf-8", "replace")
                grouped = decision is not None and decision[0] == key
                # the first row with the largest id answers for its group
                first = grouped and page_id == decision[1] and answered != key
                answered = key if grouped else None
                revisit = grouped and not first
                raw = _member(_record(page_id, url or "", payload, digest, decision[1] if revisit else None, revisit))
                if out is not None and out[3] + len(raw) > file_bytes:
                    close()
                    part += 1
                if out is None:
                    name = f"_temporary/{attempt}-{shard:06d}-{part:04d}"
                    out = [files.open_output_stream(f"{target}/{name}", compression=None), name, 0, 0, hashlib.sha256()]
                out[0].write(raw)
                out[2] += 1
                out[3] += len(raw)
                out[4].update(raw)
        close()
        names = ["shard", "part", "temporary", "name", "records", "n_bytes", "sha256"]
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(done, columns=names).astype({"shard": "int32", "part": "int32", "records": "int64", "n_bytes": "int64"}), preserve_index=False
        )

    return run


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as archives below ``folder``, which must be new."""
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
        "url",
        "html",
    )
    skinny = materialize(named.select("page_id", "digest", "n_bytes"), "warc-digests")
    starts = shard_starts(skinny, shard_bytes)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        known = page_id.notna()
        out = np.zeros(len(page_id), np.int32)
        out[known] = np.searchsorted(starts, page_id[known].to_numpy(np.int64), side="right")
        return pd.Series(out)

    groups = (
        skinny.filter(F.col("n_bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    groups = materialize(groups, "warc-groups")
    decisions = skinny.join(groups, "digest").select(
        "page_id", "digest", F.lit(True).alias("is_decision"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to"
    )
    records = named.select("page_id", "digest", F.lit(False).alias("is_decision"), "url", "html", F.lit(None).cast("long").alias("refers_to"))
    dealt = records.unionByName(decisions).select(shard_of("page_id").alias("shard"), "*")
    (
        dealt.repartitionById(len(starts) + 1, "shard")
        .sortWithinPartitions("shard", "page_id", "digest", F.col("is_decision").desc(), "url")
        .mapInArrow(_write_shards(folder, file_bytes), MANIFEST)
        .write.parquet(f"{folder}/_manifest")
    )
    _commit(spark, folder)


def _commit(spark: SparkSession, folder: str) -> None:
    """Move the listed files to their final names; may be repeated."""

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, target = file_system(folder)
        for frame in frames:
            for row in frame.itertuples():
                final, temporary = f"{target}/{row.name}", f"{target}/{row.temporary}"
                if files.get_file_info(temporary).type != fs.FileType.NotFound:
                    files.move(temporary, final)
                elif files.get_file_info(final).size != row.n_bytes:
                    raise FileNotFoundError(final)
            yield frame[["n_bytes"]]

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select(F.col("name").alias("name"), "temporary", "n_bytes")
    listed.mapInPandas(move, "n_bytes long").agg(F.sum("n_bytes")).collect()
    remove_folder(spark, f"{folder}/_temporary")


# ---- reader


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all listed files, one ``RECORD`` row each; every digest is checked while reading."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        files, target = file_system(folder)
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("record_type", pa.string()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("refers_to", pa.int64()),
                ("payload", pa.binary()),
            ]
        )
        for frame in frames:
            for name in frame.column("name").to_pylist():
                rows = []
                with files.open_input_stream(f"{target}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        row = parse(raw)
                        rows.append(row if payloads else (*row[:-1], None))
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("name")
    cores = spark.sparkContext.defaultParallelism
    return listed.repartition(4 * cores, "name").mapInArrow(read, RECORD)


def _members(stream) -> Iterator[bytes]:
    """Unpacked gzip members of a stream."""
    unpacker, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            return
        parts.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            yield b"".join(parts)
            data, parts, unpacker = unpacker.unused_data, [], zlib.decompressobj(31)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives and read them back."""
    folder = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = f"""
WITH digested AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url) AS rank,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url) AS response
  FROM digested)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN rank > 1 AND payload_bytes >= {LEAST_REVISIT} THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN rank > 1 AND payload_bytes >= {LEAST_REVISIT} THEN response END AS refers_to
FROM ranked
"""
