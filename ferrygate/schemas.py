"""Endpoint registry, table schemas, declared tests and column grants."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

TEXT, INT, DOUBLE, LONG = StringType(), IntegerType(), DoubleType(), LongType()


def _text_columns(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


@dataclass(frozen=True)
class Endpoint:
    """One logical source: its path dimensions, pinned fields and gate options."""

    name: str
    dims: tuple[str, ...] = ()
    fields: StructType = field(default_factory=StructType)
    # filter parameter -> record field
    filters: dict[str, str | None] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    dedup: tuple[str, ...] = ()
    freq_check: bool = False
    min_rows: int = 1


# Field names of the public trade API and the gate options per source.
_FLOW_FIELDS = (
    "typeCode", "freqCode", "period",
    "reporterCode", "reporterISO", "reporterDesc",
    "partnerCode", "partnerISO", "partnerDesc",
    "cmdCode", "cmdDesc", "flowCode", "flowDesc", "primaryValue",
)
_FLOW_KEY = ("reporterCode", "partnerCode", "cmdCode", "flowCode", "period")
_CODE_FILTERS = {
    name: name for name in ("reporterCode", "period", "partnerCode", "cmdCode", "flowCode")
}
_PATH_FILTERS = {"typeCode": "typeCode", "freqCode": "freqCode"}

ENDPOINTS: dict[str, Endpoint] = {
    spec.name: spec
    for spec in (
        Endpoint(
            "preview",
            dims=("type", "freq"),
            fields=_text_columns(*_FLOW_FIELDS),
            filters={**_PATH_FILTERS, **_CODE_FILTERS},
            required=("reporterCode", "period"),
            numeric=("primaryValue",),
            dedup=_FLOW_KEY,
            freq_check=True,
        ),
        Endpoint(
            "previewTariffline",
            dims=("type", "freq"),
            fields=_text_columns(*_FLOW_FIELDS, "partner2Code", "customsCode", "motCode"),
            filters={
                **_PATH_FILTERS,
                **_CODE_FILTERS,
                "partner2Code": "partner2Code",
                "customsCode": "customsCode",
                "motCode": "motCode",
            },
            required=("reporterCode", "period"),
            numeric=("primaryValue",),
            dedup=(*_FLOW_KEY, "motCode"),
            freq_check=True,
        ),
        Endpoint(
            "getWorldShare",
            dims=("type", "freq"),
            fields=_text_columns("typeCode", "freqCode", "period", "reporterCode", "share"),
            filters={**_PATH_FILTERS, "period": "period", "reporterCode": "reporterCode"},
            required=("reporterCode", "period"),
            numeric=("share",),
            dedup=("reporterCode", "period"),
            freq_check=True,
        ),
        Endpoint("getMetadata", dims=("type", "freq")),
        Endpoint(
            "getMBS",
            dims=("series_type",),
            fields=_text_columns(
                "period", "freqCode", "seriesType", "seriesDesc",
                "reporterCode", "reporterISO", "reporterDesc", "primaryValue",
            ),
            filters={
                "series_type": "seriesType",
                "country_code": "reporterCode",
                "period": "period",
                "period_type": "freqCode",
                "year": "period",
                "table_type": "tableType",
                "format": None,  # shape of the response, not of its rows
            },
        ),
        Endpoint(
            "getDATariffline",
            dims=("type", "freq"),
            fields=_text_columns("typeCode", "freqCode", "period", "reporterCode", "primaryValue"),
            filters=_PATH_FILTERS,
            required=("reporterCode",),
            numeric=("primaryValue",),
            freq_check=True,
        ),
        Endpoint(
            "getDA",
            dims=("type", "freq"),
            fields=_text_columns("typeCode", "freqCode", "period", "reporterCode", "primaryValue"),
            filters=_PATH_FILTERS,
            required=("reporterCode",),
            numeric=("primaryValue",),
            freq_check=True,
        ),
        # The release list has no dimensions, pinned fields or content checks; see endpoint().
        Endpoint("getReleases"),
    )
}

BRONZE_TABLES = tuple(ENDPOINTS)
SILVER_TABLES = ("reporter_summary", "trade_flows")
BACKFILL_ENDPOINTS = ("preview", "previewTariffline", "getMBS")


def endpoint(name: str) -> Endpoint:
    """Registry entry, matched without regard to case.

    A source that is not registered is handled like the release list: no path
    dimensions, every field kept in ``_extra``, structural checks only.
    """
    for known, spec in ENDPOINTS.items():
        if known.lower() == name.lower():
            return spec
    return Endpoint(name)


STG_PREVIEW = StructType(
    [
        StructField("reporter_code", INT),
        StructField("reporter_iso", TEXT),
        StructField("reporter_name", TEXT),
        StructField("partner_code", INT),
        StructField("partner_iso", TEXT),
        StructField("partner_name", TEXT),
        StructField("commodity_code", TEXT),
        StructField("commodity_name", TEXT),
        StructField("flow_code", TEXT),
        StructField("flow_name", TEXT),
        StructField("period", TEXT),
        StructField("freq_code", TEXT),
        StructField("type_code", TEXT),
        StructField("trade_value_usd", DOUBLE),
    ]
)
STG_MBS = StructType(
    [
        StructField("period", TEXT),
        StructField("freq_code", TEXT),
        StructField("series_type", TEXT),
        StructField("series_name", TEXT),
        StructField("reporter_code", INT),
        StructField("reporter_iso", TEXT),
        StructField("reporter_name", TEXT),
        StructField("trade_value_usd", DOUBLE),
    ]
)
TRADE_FLOWS = StructType(
    [
        StructField("period", TEXT),
        StructField("freq_code", TEXT),
        StructField("type_code", TEXT),
        StructField("reporter_code", INT),
        StructField("reporter_iso", TEXT),
        StructField("reporter_name", TEXT),
        StructField("partner_code", INT),
        StructField("partner_iso", TEXT),
        StructField("partner_name", TEXT),
        StructField("commodity_code", TEXT),
        StructField("commodity_name", TEXT),
        StructField("flow_code", TEXT),
        StructField("flow_name", TEXT),
        StructField("trade_value_usd", DOUBLE),
        StructField("source_record_count", LONG),
    ]
)
REPORTER_SUMMARY = StructType(
    [
        StructField("period", TEXT),
        StructField("freq_code", TEXT),
        StructField("reporter_code", INT),
        StructField("reporter_iso", TEXT),
        StructField("reporter_name", TEXT),
        StructField("export_value_usd", DOUBLE),
        StructField("import_value_usd", DOUBLE),
        StructField("total_trade_value_usd", DOUBLE),
        StructField("trade_balance_usd", DOUBLE),
        StructField("commodity_count", LONG),
        StructField("partner_count", LONG),
    ]
)

TRADE_FLOWS_KEY = (
    "period", "freq_code", "type_code", "reporter_code", "partner_code", "commodity_code",
    "flow_code",
)
REPORTER_SUMMARY_KEY = ("period", "freq_code", "reporter_code")

# staged column <- (bronze column, type)
PREVIEW_RENAMES = {
    "reporter_code": ("reportercode", "int"),
    "reporter_iso": ("reporteriso", "string"),
    "reporter_name": ("reporterdesc", "string"),
    "partner_code": ("partnercode", "int"),
    "partner_iso": ("partneriso", "string"),
    "partner_name": ("partnerdesc", "string"),
    "commodity_code": ("cmdcode", "string"),
    "commodity_name": ("cmddesc", "string"),
    "flow_code": ("flowcode", "string"),
    "flow_name": ("flowdesc", "string"),
    "period": ("period", "string"),
    "freq_code": ("freqcode", "string"),
    "type_code": ("typecode", "string"),
    "trade_value_usd": ("primaryvalue", "double"),
}
MBS_RENAMES = {
    "period": ("period", "string"),
    "freq_code": ("freqcode", "string"),
    "series_type": ("seriestype", "string"),
    "series_name": ("seriesdesc", "string"),
    "reporter_code": ("reportercode", "int"),
    "reporter_iso": ("reporteriso", "string"),
    "reporter_name": ("reporterdesc", "string"),
    "trade_value_usd": ("primaryvalue", "double"),
}

# Accepted codes and declared column tests per table.
FLOW_CODES = ("M", "X", "Re-Import", "Re-Export")
FREQ_CODES = ("A", "M")

NOT_NULL: dict[str, tuple[str, ...]] = {
    "preview": ("reportercode", "partnercode", "flowcode", "period"),
    "previewtariffline": ("reportercode", "period"),
    "getmbs": ("period",),
    "stg_preview": ("reporter_code", "partner_code", "flow_code", "period"),
    "stg_mbs": ("period",),
    "trade_flows": ("period", "reporter_code", "partner_code", "flow_code", "trade_value_usd"),
    "reporter_summary": ("period", "reporter_code"),
}
ACCEPTED_VALUES: dict[str, dict[str, tuple[str, ...]]] = {
    "preview": {"flowcode": FLOW_CODES},
    "stg_preview": {"flow_code": FLOW_CODES, "freq_code": FREQ_CODES},
    "trade_flows": {"flow_code": FLOW_CODES},
}
NON_NEGATIVE: dict[str, tuple[str, ...]] = {
    "trade_flows": ("trade_value_usd",),
    "reporter_summary": ("export_value_usd", "import_value_usd"),
}

# Columns each principal may read. None means all columns.
_API_FLOW_COLUMNS = (
    "period", "freq_code", "reporter_iso", "reporter_name", "partner_iso", "partner_name",
    "commodity_code", "commodity_name", "flow_code", "trade_value_usd",
)
GRANTS: dict[str, dict[str, tuple[str, ...] | None]] = {
    "orchestrator": {"trade_flows": None, "reporter_summary": None},
    "bi": {"trade_flows": None, "reporter_summary": None},
    "api": {"trade_flows": _API_FLOW_COLUMNS, "reporter_summary": None},
}
