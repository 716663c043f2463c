"""What a stream of many small files costs besides its rows."""

from pathlib import Path

from pyarrow.parquet import ParquetFile

from ferrygate.session import materialize
from ferrygate.sources.landing import land_envelopes
from ferrygate.streaming.landing import start_landing_load


def test_the_stream_lists_files_in_few_tasks(spark, root):
    names = ["run_id", "type", "freq", "year", "month", "body"]
    land_envelopes(spark.createDataFrame([("a", "C", "A", "2024", "03", "{}")], names), f"{root}/raw", "preview")
    start_landing_load(spark, f"{root}/raw", f"{root}/bronze", f"{root}/state", f"{root}/ckpt").awaitTermination()
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000")) <= 4 * spark.sparkContext.defaultParallelism


def test_copies_of_long_texts_have_small_row_groups(spark):
    copy = materialize(spark.range(100, numPartitions=1).selectExpr("id", "repeat('x', 1000) AS body"), "texts", 16)
    files = [ParquetFile(p) for p in Path(copy._scratch_path).glob("*.parquet")]
    sizes = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(sizes) == copy.count() == 100 and max(sizes) <= 16
