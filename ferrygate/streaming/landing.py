"""Incremental landing load: every new raw file goes to bronze exactly once (ST1).

The file source remembers paths. A file that is delivered again under another path, or zipped, is told by its endpoint, run
id and content: these are keys in the stream's state store, which checkpoints with the files, so restarts and repeated
batches see the same keys. The clock of that state is the time a batch starts, never a file's own stamp: no file can
be too late for it, and a key is forgotten once it is older than ``REMEMBER``.
"""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from ..plans.loads import NothingLanded, ingest, utc_now
from ..sources.envelopes import PACKED, RAW_FILES, packed_envelopes, with_envelope_columns, with_path_columns
from ..sources.packs import ENVELOPES


#: How long a delivered file is known.
REMEMBER = "90 days"
#: How much older than the newest file a file may be. Spark's own limit of a week would pass over files that were copied with their stamps.
OLDEST = "36500d"
#: What makes two files the same delivery.
DELIVERY = ("endpoint", "run_id", "digest")
#: Spark lists folders and files with a task for each of up to ten thousand; so many tasks per core do.
LISTING, LISTINGS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4


def delivered_once(files: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """The first file of each delivery; ``files`` is a stream with ``value``, ``endpoint`` and ``run_id``.

    The state holds the three short keys of a delivery, not its text. Files of one batch count as well.
    """
    keyed = files.withColumns({"digest": F.sha2("value", 256), "arrived": F.current_timestamp()})
    return keyed.withWatermark("arrived", remember).dropDuplicatesWithinWatermark([*DELIVERY]).drop("digest", "arrived")


def stream_envelopes(
    spark: SparkSession,
    root: str,
    max_files: int = 10_000,
    glob: str = RAW_FILES,
    archive: str | None = None,
    remember: str | None = REMEMBER,
    packs: bool = True,
) -> DataFrame:
    """New envelope files below ``root`` as a stream, one row per file.

    With ``archive`` finished files move there, which keeps the listing of ``root`` short. Without ``remember`` a file that
    comes again elsewhere is a file of its own. Packs are a second source; a stream that goes on from a checkpoint with one
    source needs ``packs=False``.
    """
    def source(kind: str, names: str) -> DataStreamReader:
        reader = spark.readStream.format(kind).option("recursiveFileLookup", "true").option("pathGlobFilter", names)
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        return reader.option("maxFilesPerTrigger", max_files).option("maxFileAge", OLDEST)

    files = source("text", glob).option("wholetext", "true").load(root).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    named = with_path_columns(files, root)
    if packs:
        rows = source("parquet", "*.parquet").schema(PACKED).load(f"{root.rstrip('/')}/*/{ENVELOPES}")
        named = named.unionByName(with_path_columns(packed_envelopes(rows), root))
    if remember:
        named = delivered_once(named, remember)
    return with_envelope_columns(named).drop("value")


def _list_in_few_tasks(spark: SparkSession) -> None:
    most = LISTINGS * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING, "10000")) > most:
        spark.conf.set(LISTING, str(most))


def start_landing_load(
    spark: SparkSession,
    root: str,
    bronze_root: str,
    state_root: str,
    checkpoint: str,
    name: str = "landing",
    max_files: int = 10_000,
    archive: str | None = None,
    remember: str | None = REMEMBER,
    packs: bool = True,
) -> StreamingQuery:
    """Process all files that are there now, in micro-batches, then stop.

    The checkpoint remembers which files are done, and which deliveries. A micro-batch that is repeated after a
    failure has the same batch number, hence the same load id, and replaces its own rows. The session lists
    files in few tasks from then on, because its stream does so for as long as it runs.
    """
    _list_in_few_tasks(spark)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # Nothing may be left of a batch whose files all came before.
        with suppress(NothingLanded):
            ingest(batch, bronze_root, state_root, utc_now(), f"{name}-{batch_id}")

    return (
        stream_envelopes(spark, root, max_files, archive=archive, remember=remember, packs=packs)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
