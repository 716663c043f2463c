"""Scan of landed envelopes and of landed record lines.

An envelope file becomes one row; its records become rows by ``explode``, so checks, drift and
bronze loading run over all files of all endpoints in one job. Envelopes are small (hundreds of
records) by contract. A source that lands large volumes writes one record per line instead,
which Spark splits by byte range.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..filesystem import matching
from ..schemas import endpoint as endpoint_spec
from . import packs
from .layout import partition_columns, path_endpoint, path_run_id, path_value

_JSON_BLANKS = " \n\r\t"
FIELDS = "map<string,string>"
PACKED = "run_id string, value string"
RAW_FILES = "*.{json,txt,json.gz,txt.gz}"

# Bare words that other writers put where JSON has no value; they are read as text.
_BARE = r"(?<=[:,\[])(\s*)(-?(?:NaN|Infinity))(?=\s*[,\]}])"


@contextmanager
def text_partitions(spark: SparkSession):
    """Partition values found in paths stay text while a scan is being defined."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def with_envelope_columns(
    files: DataFrame, text: str = "value", as_json: bool = False
) -> DataFrame:
    """Add the parsed envelope to rows holding one file's text each.

    Adds ``kind`` (object, list, other, or null when unparsable), ``has_data``, ``data_is_list``,
    ``keys_present`` (objects without ``data`` only), ``elapsed_ms``, ``declared_count`` and
    ``records``, an array of record maps or, with ``as_json``, of JSON texts.

    The text is parsed inside a one-element list, because a value followed by stray text
    would otherwise pass as valid.
    """
    body = F.trim(F.col(text), F.lit(_JSON_BLANKS))
    wrapped = F.concat(F.lit("["), F.col("_body"), F.lit("]"))
    quoted = F.regexp_replace(wrapped, _BARE, '$1"$2"')
    parsed = files.withColumn("_body", body).withColumn(
        "_wrapped", F.coalesce(F.try_parse_json(wrapped), F.try_parse_json(quoted))
    )
    first, last = F.left("_body", F.lit(1)), F.right("_body", F.lit(1))
    whole = F.col("_wrapped").isNotNull() & (
        F.try_variant_get("_wrapped", "$[1]", "variant").isNull()
    )
    kind = (
        F.when(~whole | (F.col("_body") == ""), F.lit(None).cast("string"))
        .when((first == "{") & (last == "}"), F.lit("object"))
        .when((first == "[") & (last == "]"), F.lit("list"))
        .when(first.isin("{", "["), F.lit(None).cast("string"))
        .otherwise(F.lit("other"))
    )
    is_object = F.col("kind") == "object"
    items = F.when(
        F.col("kind") == "list", F.try_variant_get("_wrapped", "$[0]", "array<variant>")
    ).when(is_object, F.try_variant_get("_wrapped", "$[0].data", "array<variant>"))
    if as_json:
        records, empty = F.transform("_items", lambda item: F.to_json(item)), "array<string>"
    else:
        records = F.transform("_items", lambda item: F.try_variant_get(item, "$", FIELDS))
        empty = f"array<{FIELDS}>"
    return (
        parsed.withColumn("kind", kind)
        .withColumn("_items", items)
        .withColumn(
            "has_data",
            is_object & F.try_variant_get("_wrapped", "$[0].data", "variant").isNotNull(),
        )
        .withColumn("data_is_list", is_object & F.col("_items").isNotNull())
        .withColumn(
            "keys_present",
            F.when(
                is_object & ~F.col("has_data"), F.array_join(F.json_object_keys("_body"), ", ")
            ),
        )
        .withColumn(
            "elapsed_ms", F.when(is_object, F.try_variant_get("_wrapped", "$[0].elapsedMs", "long"))
        )
        .withColumn(
            "declared_count", F.when(is_object, F.try_variant_get("_wrapped", "$[0].count", "long"))
        )
        .withColumn("records", F.coalesce(records, F.array().cast(empty)))
        .drop("_body", "_wrapped", "_items")
    )


def with_path_columns(files: DataFrame, root: str) -> DataFrame:
    """Endpoint, run id and path dimensions as text (``month`` keeps its leading zero).

    Envelopes of a pack bring their ``run_id``; of other files it is in the path.
    """
    path = F.col("file_path")
    return files.withColumns(
        {
            "endpoint": path_endpoint(path, root),
            "run_id": F.col("run_id") if "run_id" in files.columns else path_run_id(path),
            **{
                name: path_value(path, name)
                for name in ("type", "freq", "series_type", "year", "month")
            },
        }
    )


def read_envelopes(spark: SparkSession, root: str, glob: str = RAW_FILES) -> DataFrame:
    """All envelopes of all endpoints below ``root``, one row per file.

    Endpoints have different path dimensions, which partition discovery refuses to mix; the
    dimensions are therefore taken from each file's path. To limit the listing, pass a narrower
    ``root`` to :func:`scan_raw`. Envelopes in packs are read too, unless ``glob`` asks for certain files.
    """
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(root, wholetext=True)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
    )
    files = with_path_columns(files, root)
    if glob == RAW_FILES and (trees := matching(spark, f"{root.rstrip('/')}/*/{packs.ENVELOPES}")):
        files = files.unionByName(with_path_columns(packed_envelopes(packs.read_packs(spark, trees, PACKED)), root))
    return with_envelope_columns(files).drop("value")


def packed_envelopes(rows: DataFrame) -> DataFrame:
    """Rows of packs like those of files; a run's size is that of its own text."""
    return rows.select(
        "value", "run_id", F.col("_metadata.file_path").alias("file_path"), F.octet_length("value").cast("long").alias("file_size")
    )


def raw_folders(root: str, endpoint: str, extra: tuple[str, ...] = (), tree: str | None = None, **dims: str) -> str:
    """Folder (pattern) of an endpoint's files, narrowed by the given dimensions; with ``tree`` that of its packs."""
    names = partition_columns(endpoint_spec(endpoint))
    names = [*names[:-2], *extra, *names[-2:]]
    unknown = sorted(set(dims) - set(names))
    if unknown:
        raise ValueError(f"{endpoint} has no dimension {', '.join(unknown)}")
    depth = max((names.index(name) + 1 for name in dims), default=0)
    parts = [f"{name}={dims.get(name, '*')}" for name in names[:depth]]
    return "/".join([root.rstrip("/"), endpoint, *([tree] if tree else []), *parts])


def scan_raw(
    spark: SparkSession,
    root: str,
    endpoint: str,
    whole: bool = True,
    extra: tuple[str, ...] = (),
    **dims: str,
) -> DataFrame:
    """Raw files of one endpoint with its path dimensions as text columns.

    Only the folders of the given ``dims`` are listed (``year="2023", month="01"``). Dimensions an
    archive does not have are null. Values come from each file's path: a month folder may hold
    plain files, ``run_id=`` folders and a Parquet copy, which partition discovery refuses to mix.
    """
    names = [*partition_columns(endpoint_spec(endpoint)), *extra]

    def named(files: DataFrame) -> DataFrame:
        path = F.col("file_path")
        return files.select(
            "value",
            *(path_value(path, name).alias(name) for name in names),
            F.lit(endpoint_spec(endpoint).name).alias("endpoint"),
            F.col("run_id") if "run_id" in files.columns else path_run_id(path).alias("run_id"),
            "file_path",
            "file_size",
        )

    found = []
    folder, tree = raw_folders(root, endpoint, extra, **dims), raw_folders(root, endpoint, extra, packs.ENVELOPES, **dims)
    if matching(spark, tree):
        rows = packed_envelopes(packs.read_packs(spark, tree, PACKED))
        if not whole:
            rows = rows.withColumn("value", F.explode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r\n|\r|\n")))
        found.append(named(rows))
    if not found or matching(spark, folder):
        files = (
            spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", RAW_FILES)
            .text(folder, wholetext=whole)
        )
        size = F.col("_metadata.file_size").alias("file_size")
        found.append(named(files.select("value", F.col("_metadata.file_path").alias("file_path"), size)))
    return reduce(DataFrame.unionByName, found)


def explode_records(envelopes: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per record with its fields as a text map.

    With ``keep_empty`` an envelope without records keeps one row whose ``is_record`` is false,
    so per-run checks still see the run.
    """
    carried = [name for name in envelopes.columns if name != "records"]
    rows = envelopes.select(*carried, F.posexplode_outer("records").alias("record_no", "fields"))
    if keep_empty:
        return rows.withColumn("is_record", F.col("record_no").isNotNull())
    # An inner explode would filter on the size of the array first, and parse every envelope twice for that.
    return rows.filter(F.col("record_no").isNotNull()).drop("record_no")


def parse_record_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Landed record lines (one JSON object per row) to ``fields``; blank lines are dropped."""
    return lines.filter(F.trim(F.col(text)) != "").withColumn(
        "fields", F.try_variant_get(F.try_parse_json(text), "$", FIELDS)
    )


def field_values(records: DataFrame, names, keep=("endpoint", "run_id")) -> DataFrame:
    """Text columns for the given record fields next to ``keep``."""
    kept = [name for name in keep if name in records.columns]
    return records.select(*kept, *(F.col("fields")[name].alias(name) for name in names))


def typed_records(records: DataFrame, endpoint: str, keep=("endpoint", "run_id")) -> DataFrame:
    """Pinned text columns of the endpoint; unknown fields go to ``_extra``."""
    spec = endpoint_spec(endpoint)
    pinned = spec.fields.names
    extra = F.map_filter("fields", lambda key, _: ~key.isin(*pinned) if pinned else F.lit(True))
    kept = [name for name in keep if name in records.columns]
    return records.select(
        *kept,
        *(F.col("fields")[name].alias(name) for name in pinned),
        F.when(F.size(extra) > 0, extra).alias("_extra"),
    )


def matches_list(column: Column, codes: str) -> Column:
    """Membership in a comma-separated code list."""
    wanted = [code.strip() for code in codes.split(",") if code.strip()]
    return column == wanted[0] if len(wanted) == 1 else column.isin(*wanted)


def filter_endpoint(records: DataFrame, endpoint: str, **params: str | None) -> DataFrame:
    """Apply an endpoint's optional filter parameters to landed or bronze rows.

    A parameter that is ``None`` does not filter; several codes are separated by commas.
    """
    allowed = endpoint_spec(endpoint).filters
    unknown = sorted(name for name in params if name not in allowed)
    if unknown:
        raise ValueError(f"{endpoint} has no filter {', '.join(unknown)}")
    columns = {name.lower() for name in records.columns}
    for name, codes in params.items():
        if codes is None or allowed[name] is None:
            continue
        field_name = allowed[name]
        if name == "year":
            value = F.substring(field_name, 1, 4)
        elif field_name.lower() in columns:
            value = F.col(field_name)
        else:
            value = F.col("_extra")[field_name]
        records = records.filter(matches_list(value, str(codes)))
    return records
