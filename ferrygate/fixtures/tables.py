"""Trade-schema views of the generic tables.

Order lines play flow records: customer nation reports, supplier nation is the partner, the part
type is the commodity. Every view covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lineage import run_events
from ..schemas import ENDPOINTS
from ..sources.deadletter import manifests

ENDPOINT = "preview"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its footer is read for the schema only the first time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _nation(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.alias(f"{role}_key"),
        key.cast("string").alias(f"{role}code"),
        F.concat(F.lit("N"), F.char(key + 65)).alias(f"{role}iso"),
        F.col("n_name").alias(f"{role}desc"),
    )


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records with load stamp and run id, plus ``l_orderkey`` to derive dirty values."""
    # The given file of order lines is one row group, which one task reads: dealt out by the key that the orders are joined on,
    # which needs no exchange of its own then. Names come last, so that no exchange carries them.
    line = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    reporter = _nation(spark, sf_dir, "reporter")
    partner = _nation(spark, sf_dir, "partner")
    annual = F.col("l_linestatus") == "F"
    year = F.year("l_shipdate").cast("string")
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    flag = F.col("l_returnflag")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    rows = (
        line.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(partner, F.col("s_nationkey") == F.col("partner_key"))
        .join(reporter, F.col("c_nationkey") == F.col("reporter_key"))
    )
    freq = F.when(annual, "A").otherwise("M")
    return rows.select(
        F.lit(ENDPOINT).alias("endpoint"),
        F.concat_ws("-", F.lit("orders"), F.year("o_orderdate").cast("string"), freq).alias(
            "run_id"
        ),
        "l_orderkey",
        "reportercode",
        "reporteriso",
        "reporterdesc",
        "partnercode",
        "partneriso",
        "partnerdesc",
        F.col("p_type").alias("cmdcode"),
        F.concat(F.lit("Goods: "), F.col("p_type")).alias("cmddesc"),
        F.when(flag == "A", "X").when(flag == "R", "M").otherwise("Re-Export").alias("flowcode"),
        F.when(flag == "A", "Export")
        .when(flag == "R", "Import")
        .otherwise("Re-Export")
        .alias("flowdesc"),
        F.when(annual, year).otherwise(F.concat(year, month)).alias("period"),
        freq.alias("freqcode"),
        F.lit("C").alias("typecode"),
        F.col("l_extendedprice").alias("primaryvalue"),
        F.concat(F.date_format("o_orderdate", ISO_FORMAT), F.lit("+00:00")).alias("_loaded_at"),
    )


def _every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


def dirty_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records with missing, negative, unreadable and misformed values; all text."""
    rows = bronze_preview(spark, sf_dir)
    code = F.col("reportercode")
    value = F.col("primaryvalue")
    return rows.withColumns(
        {
            "reportercode": F.when(_every(97), F.lit(None).cast("string"))
            .when(_every(101), F.lit(""))
            .otherwise(code),
            "primaryvalue": F.when(_every(83), F.lit("n/a"))
            .when(_every(89), (-value).cast("string"))
            .otherwise(value.cast("string")),
            "period": F.when(_every(79), F.lit("20X3")).otherwise(F.col("period")),
            "flowcode": F.when(_every(73), F.lit("ZZ")).otherwise(F.col("flowcode")),
        }
    )


def bronze_mbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as bulletin series."""
    return as_series(bronze_preview(spark, sf_dir))


def as_series(rows: DataFrame) -> DataFrame:
    return rows.select(
        "period",
        "freqcode",
        F.lit("T35").alias("seriestype"),
        F.lit("Total trade").alias("seriesdesc"),
        "reportercode",
        "reporteriso",
        "reporterdesc",
        "primaryvalue",
        "_loaded_at",
    )


def landed_fields(rows: DataFrame) -> DataFrame:
    """Flow records under the endpoint's own field names, as text."""
    return rows.select(*(F.col(n).cast("string").alias(n) for n in ENDPOINTS[ENDPOINT].fields.names))


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_of(table(spark, sf_dir, "events"))


def points_of(events: DataFrame) -> DataFrame:
    """Events as metric points."""
    kind = F.col("event_type")
    user = F.col("user_id")
    dag = F.concat(F.lit("dag-"), user.cast("string"))
    phase = F.concat(F.lit("phase-"), (user % 5).cast("string"))
    return events.select(
        "ts",
        F.when(kind == "view", "ChecksPassed")
        .when(kind == "error", "ChecksFailed")
        .when(kind == "click", "RowCount")
        .when(kind == "purchase", "JsonBytesWritten")
        .otherwise("DbtRunDuration")
        .alias("metric"),
        F.when(kind == "purchase", "Bytes").when(kind == "signup", "Seconds").otherwise("Count").alias("unit"),
        "value",
        F.when(kind == "signup", F.create_map(F.lit("DagId"), dag, F.lit("Phase"), phase))
        .otherwise(F.create_map(F.lit("DagId"), dag, F.lit("Endpoint"), F.lit(ENDPOINT)))
        .alias("dims"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run-log lines; every fiftieth line is cut short."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "error").when(kind == "signup", "fail").otherwise("success")
    line = F.to_json(
        F.struct(
            F.struct(F.struct(status.alias("node_status")).alias("node_info")).alias("data"),
            F.col("event_id"),
        )
    )
    broken = F.substring(line, 1, 45)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("phase-"), (F.col("user_id") % 5).cast("string")).alias("phase"),
        F.when(F.col("event_id") % 50 == 0, broken).otherwise(line).alias("value"),
    )


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lineage run events; views write nothing."""
    kind = F.col("event_type")
    tasks = table(spark, sf_dir, "events").select(
        F.concat(F.lit("dag_"), kind).alias("dag_id"),
        F.lit("extract").alias("task_id"),
        F.concat(F.lit("run:"), F.col("event_id").cast("string")).alias("run_id"),
        F.date_format("ts", ISO_FORMAT).alias("event_time"),
        F.array(
            F.concat(F.lit("https://api.example.org/v1/"), kind),
            F.concat(F.lit("s3://lake/in/"), F.col("user_id").cast("string")),
        ).alias("input_uris"),
        F.when(kind == "view", F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("s3://lake/out/"), kind)))
        .alias("output_uris"),
    )
    return run_events(tasks, "trade", "urn:ferrygate")


def event_stamp() -> Column:
    return F.concat(F.date_format("ts", f"{ISO_FORMAT}.SSSSSS"), F.lit("+00:00"))


def error_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dead-letter manifests."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("dag_"), F.col("event_type")).alias("dag_id"),
        F.concat(F.lit("task_"), (F.col("user_id") % 3).cast("string")).alias("task_id"),
        F.concat(F.lit("run:"), F.col("event_id").cast("string")).alias("run_id"),
        event_stamp().alias("execution_date"),
        event_stamp().alias("failed_at"),
        F.when(F.col("event_type") == "error", "ValueError").alias("exception_type"),
        F.col("props").alias("exception_message"),
    )
    return manifests(rows, "2024-02-01T00:00:00+00:00")


def user_key_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sparse JSON records per endpoint, keyed by user and property, with their day."""
    prop = F.get_json_object("props", "$.k")
    key = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), prop)
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        F.to_json(F.create_map(key, F.col("value"))).alias("record"),
        F.col("ts").cast("date").alias("day"),
    )
