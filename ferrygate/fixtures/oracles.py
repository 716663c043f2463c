"""DuckDB statements answering each registered query from the same tables."""

from __future__ import annotations

from . import registry as r

MONEY = "DECIMAL(24,6)"

_BRONZE = """
bronze AS (
  SELECT 'preview' AS endpoint, l_orderkey,
    concat('orders-', strftime(o_orderdate, '%Y'), '-',
           CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'M' END) AS run_id,
    CAST(rep.n_nationkey AS VARCHAR) AS reportercode,
    concat('N', chr(65 + rep.n_nationkey)) AS reporteriso, rep.n_name AS reporterdesc,
    CAST(par.n_nationkey AS VARCHAR) AS partnercode,
    concat('N', chr(65 + par.n_nationkey)) AS partneriso, par.n_name AS partnerdesc,
    p_type AS cmdcode, concat('Goods: ', p_type) AS cmddesc,
    CASE l_returnflag WHEN 'A' THEN 'X' WHEN 'R' THEN 'M' ELSE 'Re-Export' END AS flowcode,
    CASE l_returnflag WHEN 'A' THEN 'Export' WHEN 'R' THEN 'Import' ELSE 'Re-Export' END AS flowdesc,
    CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y')
         ELSE strftime(l_shipdate, '%Y%m') END AS period,
    CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'M' END AS freqcode,
    'C' AS typecode, l_extendedprice AS primaryvalue, o_orderdate AS loaded
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation rep ON c_nationkey = rep.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation par ON s_nationkey = par.n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

_DIRTY = """
dirty AS (
  SELECT * REPLACE (
    CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN ''
         ELSE reportercode END AS reportercode,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN -primaryvalue
         ELSE primaryvalue END AS primaryvalue,
    CASE WHEN l_orderkey % 79 = 0 THEN '20X3' ELSE period END AS period,
    CASE WHEN l_orderkey % 73 = 0 THEN 'ZZ' ELSE flowcode END AS flowcode)
  FROM bronze
)"""

_STAGE = """
  SELECT CAST(reportercode AS INTEGER) AS reporter_code, reporteriso AS reporter_iso,
    reporterdesc AS reporter_name, CAST(partnercode AS INTEGER) AS partner_code,
    partneriso AS partner_iso, partnerdesc AS partner_name, cmdcode AS commodity_code,
    cmddesc AS commodity_name, flowcode AS flow_code, flowdesc AS flow_name, period,
    freqcode AS freq_code, typecode AS type_code,
    CAST(primaryvalue AS DOUBLE) AS trade_value_usd
  FROM {source}"""

_STAGED = "staged AS (" + _STAGE.format(source="bronze") + ")"
# Rows the lenient staging keeps: the reporter reads as a number and the value is one.
_LENIENT = (
    "staged AS ("
    + _STAGE.format(source="dirty")
    + " WHERE reportercode <> '' AND period IS NOT NULL AND primaryvalue IS NOT NULL)"
)

_FLOWS = """
  SELECT period, freq_code, type_code, reporter_code, reporter_iso, reporter_name, partner_code,
    partner_iso, partner_name, commodity_code, commodity_name, flow_code, flow_name,
    CAST(sum(CAST(trade_value_usd AS {money})) AS DOUBLE) AS trade_value_usd,
    count(*) AS source_record_count
  FROM {source} WHERE trade_value_usd >= 0
  GROUP BY ALL"""

_SUMMARY = """
  SELECT period, freq_code, reporter_code, reporter_iso, reporter_name,
    CAST(x AS DOUBLE) AS export_value_usd, CAST(m AS DOUBLE) AS import_value_usd,
    CAST(total AS DOUBLE) AS total_trade_value_usd, CAST(x - m AS DOUBLE) AS trade_balance_usd,
    commodity_count, partner_count
  FROM (
    SELECT period, freq_code, reporter_code, reporter_iso, reporter_name,
      sum(CAST(CASE WHEN flow_code = 'X' THEN trade_value_usd ELSE 0 END AS {money})) AS x,
      sum(CAST(CASE WHEN flow_code = 'M' THEN trade_value_usd ELSE 0 END AS {money})) AS m,
      sum(CAST(trade_value_usd AS {money})) AS total,
      count(DISTINCT commodity_code) AS commodity_count,
      count(DISTINCT partner_code) AS partner_count
    FROM {source} WHERE trade_value_usd >= 0
    GROUP BY period, freq_code, reporter_code, reporter_iso, reporter_name)"""


def _flows(source: str = "staged") -> str:
    return _FLOWS.format(money=MONEY, source=source)


def _summary(source: str = "staged") -> str:
    return _SUMMARY.format(money=MONEY, source=source)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


_CLEAN = _with(_BRONZE, _STAGED)
_ON_SUMMARY = _with(_BRONZE, _STAGED, f"reporter_summary AS ({_summary()})")
_ON_FLOWS = _with(_BRONZE, _STAGED, f"trade_flows AS ({_flows()})")
_ON_DIRTY = _with(_BRONZE, _DIRTY)


def _round(value: str, digits: int) -> str:
    f = float(10**digits)
    return f"(sign({value}) * floor(abs({value}) * {f}::DOUBLE + 0.5::DOUBLE) / {f}::DOUBLE + 0.0::DOUBLE)"


def _scaled(column: str, digits: int) -> str:
    return _round(f"({column} / {float(r.UNIT)}::DOUBLE)", digits)


def _growth(curr: str, base: str) -> str:
    return _round(f"(100.0::DOUBLE * ({curr} - {base}) / nullif({base}, 0.0::DOUBLE))", 1)


_MEASURES = (
    "export_value_usd, import_value_usd, total_trade_value_usd, trade_balance_usd, "
    "commodity_count, partner_count"
)

# ---- checks: one counts relation per run, then one select per check ---------------------------

_COUNTS = """
counts AS (
  SELECT endpoint, run_id, count(*) AS n,
    count(*) FILTER (WHERE reportercode IS NULL OR reportercode = '') AS null_reporter,
    count(*) FILTER (WHERE primaryvalue < 0) AS negative,
    count(*) FILTER (WHERE period = '20X3') AS bad_periods,
    count(*) - count(DISTINCT (coalesce(reportercode, '~'), partnercode, cmdcode, flowcode, period))
      AS repeated,
    max(freqcode) AS freq
  FROM dirty GROUP BY endpoint, run_id
)"""

_KEYS = "reporterCode, partnerCode, cmdCode, flowCode, period"


def _row_count(minimum: int) -> str:
    return f"""
  SELECT endpoint, run_id, 'check_row_count' AS name, n >= {minimum} AS passed,
    'error' AS severity, concat(n, ' rows, at least {minimum} expected') AS message,
    CASE WHEN n >= {minimum} THEN concat('row_count=', n)
         ELSE concat('min_rows={minimum},row_count=', n) END AS details FROM counts"""


_NO_NULLS = """
  SELECT endpoint, run_id, 'check_no_nulls' AS name, null_reporter = 0 AS passed,
    'error' AS severity,
    CASE WHEN null_reporter = 0 THEN 'no missing values in reporterCode, period'
         ELSE 'missing values in reporterCode' END AS message,
    CASE WHEN null_reporter = 0 THEN '' ELSE concat('null.reporterCode=', null_reporter) END
      AS details FROM counts"""

_NON_NEGATIVE = """
  SELECT endpoint, run_id, 'check_numeric_non_negative' AS name, negative = 0 AS passed,
    'warning' AS severity,
    CASE WHEN negative = 0 THEN 'no negative values in primaryValue'
         ELSE 'negative values in primaryValue' END AS message,
    CASE WHEN negative = 0 THEN '' ELSE concat('negative.primaryValue=', negative) END AS details
  FROM counts"""

_SAMPLE = "array_to_string(list_resize(list_value('20X3','20X3','20X3','20X3','20X3'), least(bad_periods, 5)::INT), ', ')"
_PERIODS = f"""
  SELECT endpoint, run_id, 'check_period_format' AS name, bad_periods = 0 AS passed,
    'error' AS severity,
    concat(CASE WHEN bad_periods = 0 THEN 'all periods are ' ELSE 'periods are not ' END,
      CASE freq WHEN 'A' THEN 'YYYY' ELSE 'YYYYMM' END,
      CASE WHEN bad_periods = 0 THEN '' ELSE concat(': ', {_SAMPLE}) END) AS message,
    CASE WHEN bad_periods = 0 THEN ''
         ELSE concat('sample=', {_SAMPLE}, ',total_bad=', bad_periods) END AS details FROM counts"""

_DUPLICATES = f"""
  SELECT endpoint, run_id, 'check_no_duplicates' AS name, repeated = 0 AS passed,
    'warning' AS severity,
    CASE WHEN repeated = 0 THEN 'no repeated key {_KEYS}'
         ELSE concat(repeated, ' repeated on {_KEYS}') END AS message,
    CASE WHEN repeated = 0 THEN '' ELSE concat('duplicate_count=', repeated) END AS details
  FROM counts"""

_SUITE = " UNION ALL ".join((_row_count(1), _NO_NULLS, _NON_NEGATIVE, _PERIODS, _DUPLICATES))
_CHECKED = _with(_BRONZE, _DIRTY, _COUNTS)
_RESULTS = _with(_BRONZE, _DIRTY, _COUNTS, f"results AS ({_SUITE})")

# ---- column tests ----------------------------------------------------------------------------

_TESTED = _with(
    _BRONZE,
    _DIRTY,
    _LENIENT,
    f"trade_flows AS ({_flows()})",
    f"reporter_summary AS ({_summary()})",
)


def _test(table: str, relation: str, test: str, column: str, failing: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS column_name, "
        f"count(*) FILTER (WHERE {failing}) AS failures FROM {relation}"
    )


def _not_null() -> str:
    columns = {
        ("preview", "dirty"): ("reportercode", "partnercode", "flowcode", "period"),
        ("previewtariffline", "dirty"): ("reportercode", "period"),
        ("getmbs", "dirty"): ("period",),
        ("stg_mbs", "dirty"): ("period",),
        ("stg_preview", "staged"): ("reporter_code", "partner_code", "flow_code", "period"),
        ("trade_flows", "trade_flows"): (
            "period", "reporter_code", "partner_code", "flow_code", "trade_value_usd",
        ),
        ("reporter_summary", "reporter_summary"): ("period", "reporter_code"),
    }
    return " UNION ALL ".join(
        _test(table, relation, "not_null", column, f"{column} IS NULL")
        for (table, relation), names in columns.items()
        for column in names
    )


def _accepted() -> str:
    flow = "NOT IN ('M', 'X', 'Re-Import', 'Re-Export')"
    return " UNION ALL ".join(
        _test(table, relation, "accepted_values", column, f"{column} {rule}")
        for table, relation, column, rule in (
            ("preview", "dirty", "flowcode", flow),
            ("stg_preview", "staged", "flow_code", flow),
            ("stg_preview", "staged", "freq_code", "NOT IN ('A', 'M')"),
            ("trade_flows", "trade_flows", "flow_code", flow),
        )
    )


def _expressions() -> str:
    return " UNION ALL ".join(
        _test(table, table, "expression_is_true", column, f"NOT ({column} >= 0)")
        for table, column in (
            ("trade_flows", "trade_value_usd"),
            ("reporter_summary", "export_value_usd"),
            ("reporter_summary", "import_value_usd"),
        )
    )


# ---- upsert: source rows win, unmatched target rows stay ----------------------------------------

_SPLIT = str(r.SPLIT_YEAR)
_OLDER = f"older AS (SELECT * FROM staged WHERE period[1:4] <= '{_SPLIT}')"
_NEWER = f"""newer AS (SELECT * REPLACE (trade_value_usd * 2 AS trade_value_usd) FROM staged
  WHERE period[1:4] >= '{_SPLIT}')"""


def _upserted(aggregate, keys) -> str:
    same = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    return (
        _with(
            _BRONZE, _STAGED, _OLDER, _NEWER,
            f"t AS ({aggregate('older')})", f"s AS ({aggregate('newer')})",
        )
        + f" SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {same})"
    )


# ---- observability ------------------------------------------------------------------------------

_POINTS = """
points AS (
  SELECT ts, value, user_id,
    CASE event_type WHEN 'view' THEN 'ChecksPassed' WHEN 'error' THEN 'ChecksFailed'
      WHEN 'click' THEN 'RowCount' WHEN 'purchase' THEN 'JsonBytesWritten'
      ELSE 'DbtRunDuration' END AS metric,
    CASE event_type WHEN 'signup' THEN concat('DagId=dag-', user_id, ',Phase=phase-', user_id % 5)
      ELSE concat('DagId=dag-', user_id, ',Endpoint=preview') END AS dims,
    CAST(ts AS DATE) AS day
  FROM events
)"""

_UUID = "sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(concat('run:', event_id)))"

_PII_KINDS = {
    "card": (
        r"len(list_filter(regexp_extract_all({c}, '{number}'), lambda x: "
        r"regexp_full_match(x, '[0-9]+|{card}') AND "
        r"length(replace(replace(x, ' ', ''), '-', '')) BETWEEN 13 AND 19 AND "
        r"list_sum(list_transform(string_split(reverse(replace(replace(x, ' ', ''), '-', '')), ''), "
        r"lambda d, i: CASE WHEN i % 2 = 1 THEN try_cast(d AS INT) WHEN try_cast(d AS INT) > 4 THEN try_cast(d AS INT) * 2 - 9 "
        r"ELSE try_cast(d AS INT) * 2 END)) % 10 = 0))"
    ),
    "email": r"len(regexp_extract_all({c}, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}'))",
    "ip": (
        r"len(list_filter(regexp_extract_all({c}, '[0-9][0-9.]*'), lambda x: "
        r"regexp_full_match(x, '{octet}\.{octet}\.{octet}\.{octet}\.*')))"
    ),
    "phone": (
        r"len(list_filter(regexp_extract_all({c}, '{number}'), lambda x: "
        r"regexp_full_match(x, '{phone}') AND NOT regexp_full_match(x, '{card}')))"
    ),
}
_CARD = r"[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}[ \-][0-9]{4}"
_PHONE = r"(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .\-][0-9]{3,4}[ .\-][0-9]{4}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SEVERITY = {"card": "High", "email": "Medium", "phone": "Medium", "ip": "Low"}


def _pii(table: str, key: str, columns: tuple[str, ...]) -> str:
    parts = []
    for column in columns:
        for kind, count in _PII_KINDS.items():
            n = count.format(
                c=column, number=f"{_CARD}|{_PHONE}|[0-9]+", card=_CARD, phone=_PHONE, octet=_OCTET
            )
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"CAST({key} AS VARCHAR) AS row_key, '{kind}' AS kind, "
                f"'{_SEVERITY[kind]}' AS severity, CAST({n} AS INTEGER) AS n, "
                f"{str(kind == 'ip').lower()} AS low FROM {table}"
            )
    return " UNION ALL ".join(parts)


_STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_MANIFESTS = f"""
manifests AS (
  SELECT '1' AS schema_version, concat('dag_', event_type) AS dag_id,
    concat('task_', user_id % 3) AS task_id, concat('run:', event_id) AS run_id,
    {_STAMP} AS execution_date, {_STAMP} AS failed_at,
    CASE WHEN event_type = 'error' THEN 'ValueError' END AS exception_type,
    props AS exception_message, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, ts
  FROM events
)"""


def _freshness(table: str) -> str:
    now = r.FRESH_NOW[:19]
    return f"""
  SELECT '{table}' AS table_name, strftime(newest, '%Y-%m-%dT%H:%M:%S') AS max_loaded_at,
    age AS age_seconds,
    CASE WHEN age IS NULL OR age > 35 * 86400 THEN 'error' WHEN age > 26 * 86400 THEN 'warn'
         ELSE 'pass' END AS status
  FROM (SELECT max(loaded) AS newest,
          date_diff('second', max(loaded), TIMESTAMP '{now}') AS age FROM bronze)"""


def _backfill() -> str:
    asked = ", ".join(f"('{p}')" for p in r.BACKFILL_PERIODS)
    return (
        _with(_BRONZE, f"asked(period) AS (VALUES {asked})")
        + f"""
  SELECT a.period, CASE WHEN n = 0 OR spoiled > 0 THEN 'error' ELSE 'success' END AS status,
    n AS rows,
    CASE WHEN n = 0 THEN 'check_row_count: nothing landed'
         WHEN spoiled > 0 THEN 'check_no_nulls: missing values in reporterCode' END AS error
  FROM (SELECT asked.period, count(b.period) AS n,
          count(*) FILTER (WHERE b.period = '{r.YEAR}' AND l_orderkey % 97 = 0) AS spoiled
        FROM asked LEFT JOIN bronze b ON asked.period = b.period GROUP BY asked.period) a"""
    )


def _extract(table: str, columns: str) -> str:
    return f" SELECT {columns} FROM {table} WHERE freq_code = 'A'"


def _decimal(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DECIMAL(28,2)) AS {n}" for n in names)


def _int(*names: str) -> str:
    return ", ".join(f"CAST({n} AS INTEGER) AS {n}" for n in names)


ORACLES: dict[str, str] = {
    "stg_preview": _CLEAN + " SELECT * FROM staged",
    "stg_mbs": _with(_BRONZE)
    + """ SELECT period, freqcode AS freq_code, 'T35' AS series_type, 'Total trade' AS series_name,
      CAST(reportercode AS INTEGER) AS reporter_code, reporteriso AS reporter_iso,
      reporterdesc AS reporter_name, primaryvalue AS trade_value_usd FROM bronze""",
    "trade_flows": _CLEAN + _flows(),
    "reporter_summary": _CLEAN + _summary(),
    "top_exporters": _ON_SUMMARY
    + f""" SELECT reporter_iso AS country_iso, reporter_name AS country_name, period,
      {_scaled('export_value_usd', 2)} AS export_usd_bn,
      {_scaled('import_value_usd', 2)} AS import_usd_bn,
      {_scaled('trade_balance_usd', 2)} AS balance_usd_bn, commodity_count, partner_count
    FROM reporter_summary WHERE freq_code = 'A' AND period = '{r.YEAR}'
    ORDER BY export_value_usd DESC NULLS LAST, reporter_iso, reporter_code LIMIT 20""",
    "top_commodities": _ON_FLOWS
    + f""" SELECT commodity_code, commodity_name, flow_code, flow_name,
      {_scaled('trade_value_usd', 2)} AS trade_value_usd_mn, source_record_count
    FROM trade_flows
    WHERE reporter_iso = '{r.REPORTER}' AND period = '{r.YEAR}' AND freq_code = 'A'
    ORDER BY trade_value_usd DESC NULLS LAST, commodity_code, flow_code, partner_code, type_code
    LIMIT 20""",
    "bilateral_flows": _ON_FLOWS
    + f""" SELECT period, reporter_iso, partner_iso, partner_name, flow_code, flow_name,
      {_scaled('trade_value_usd', 3)} AS trade_value_usd_bn, source_record_count
    FROM trade_flows WHERE reporter_iso = '{r.REPORTER}' AND partner_iso = '{r.PARTNER}'
      AND freq_code = 'A' AND commodity_code = '{r.COMMODITY}' ORDER BY period, flow_code""",
    "yoy_growth": _ON_SUMMARY
    + f""" SELECT b.reporter_iso, b.reporter_name,
      {_scaled('c.export_value_usd', 2)} AS export_{r.YEAR}_usd_bn,
      {_scaled('b.export_value_usd', 2)} AS export_{r.BASE_YEAR}_usd_bn,
      {_growth('c.export_value_usd', 'b.export_value_usd')} AS export_growth_pct,
      {_growth('c.import_value_usd', 'b.import_value_usd')} AS import_growth_pct
    FROM reporter_summary b JOIN reporter_summary c ON b.reporter_iso = c.reporter_iso
    WHERE b.freq_code = 'A' AND b.period = '{r.BASE_YEAR}' AND c.freq_code = 'A'
      AND c.period = '{r.YEAR}' AND b.export_value_usd > 0
    ORDER BY export_growth_pct DESC NULLS LAST, b.reporter_iso LIMIT 30""",
    "data_freshness": _ON_SUMMARY
    + f""" SELECT reporter_iso, reporter_name, max(period) AS latest_period,
      count(DISTINCT period) AS period_count,
      {_scaled('max(total_trade_value_usd)', 2)} AS latest_total_trade_usd_bn
    FROM reporter_summary WHERE freq_code = 'A' GROUP BY reporter_iso, reporter_name
    ORDER BY latest_period DESC, latest_total_trade_usd_bn DESC, reporter_iso, reporter_name
    LIMIT 50""",
    "list_reporters": _ON_SUMMARY
    + f""" SELECT reporter_iso, reporter_name, period, {_MEASURES} FROM reporter_summary
    WHERE freq_code = 'A' AND period = '{r.YEAR}'
    ORDER BY total_trade_value_usd DESC NULLS LAST, period, reporter_iso LIMIT 20""",
    "reporter_series": _ON_SUMMARY
    + f""" SELECT period, {_MEASURES} FROM reporter_summary
    WHERE freq_code = 'A' AND reporter_iso = '{r.REPORTER}' ORDER BY period DESC LIMIT 10""",
    "search_flows": _ON_FLOWS
    + f""" SELECT period, reporter_iso, reporter_name, partner_iso, partner_name, commodity_code,
      commodity_name, flow_code, flow_name, trade_value_usd FROM trade_flows
    WHERE freq_code = 'A' AND reporter_iso = '{r.REPORTER}' AND period = '{r.YEAR}'
      AND flow_code = 'X'
    ORDER BY trade_value_usd DESC NULLS LAST, period, reporter_code, partner_code, commodity_code,
      flow_code, type_code LIMIT 100""",
    "bi_reporter_summary": _ON_SUMMARY
    + _extract(
        "reporter_summary",
        "period, freq_code, reporter_code, reporter_iso, reporter_name, "
        + _decimal(
            "export_value_usd", "import_value_usd", "total_trade_value_usd", "trade_balance_usd"
        )
        + ", "
        + _int("commodity_count", "partner_count"),
    ),
    "bi_trade_flows": _ON_FLOWS
    + _extract(
        "trade_flows",
        "* REPLACE ("
        + _decimal("trade_value_usd")
        + ", "
        + _int("source_record_count")
        + ")",
    ),
    "api_trade_flows_view": _ON_FLOWS
    + """ SELECT period, freq_code, reporter_iso, reporter_name, partner_iso, partner_name,
      commodity_code, commodity_name, flow_code, trade_value_usd FROM trade_flows""",
    "endpoint_filter": _with(_BRONZE)
    + f""" SELECT reportercode AS "reporterCode", partnercode AS "partnerCode",
      cmdcode AS "cmdCode", flowcode AS "flowCode", period
    FROM bronze WHERE reportercode IN ('3', '7') AND period IN ('{r.YEAR}', '199903')
      AND flowcode IN ('X', 'M')""",
    "check_row_count": _CHECKED + _row_count(4000),
    "check_no_nulls": _CHECKED + _NO_NULLS,
    "check_non_negative": _CHECKED + _NON_NEGATIVE,
    "check_period_format": _CHECKED + _PERIODS,
    "check_no_duplicates": _CHECKED + _DUPLICATES,
    "check_suite": _CHECKED + _SUITE,
    "gate_failures": _RESULTS
    + """ SELECT endpoint, run_id,
      string_agg(concat(name, ': ', message), '; ' ORDER BY concat(name, ': ', message)) AS error
    FROM results WHERE NOT passed AND severity = 'error' GROUP BY endpoint, run_id""",
    "test_not_null": _TESTED + " " + _not_null(),
    "test_accepted_values": _TESTED + " " + _accepted(),
    "test_expression": _TESTED + " " + _expressions(),
    "test_negative_value": _with(_BRONZE, _DIRTY, _LENIENT)
    + """ SELECT reporter_code, partner_code, commodity_code, flow_code, period, trade_value_usd
    FROM staged WHERE trade_value_usd < 0""",
    "quarantine": _ON_DIRTY
    + """ SELECT run_id, l_orderkey, reportercode, partnercode, period, freqcode FROM dirty
    WHERE reportercode IS NOT NULL AND (reportercode = '' OR l_orderkey % 83 = 0)""",
    "source_freshness": _with(_BRONZE) + _freshness("preview") + " UNION ALL " + _freshness("getmbs"),
    "schema_drift": f"""
    WITH keys AS (SELECT DISTINCT event_type AS endpoint, concat('u', user_id, '_', props->>'$.k') AS column_name,
        CAST(ts AS DATE) >= DATE '{r.DRIFT_DAY}' AS late FROM events),
      before AS (SELECT endpoint, column_name FROM keys WHERE NOT late),
      after AS (SELECT endpoint, column_name FROM keys WHERE late)
    SELECT endpoint, column_name, 'added' AS change FROM (FROM after EXCEPT FROM before)
    WHERE endpoint IN (SELECT endpoint FROM before)
    UNION ALL
    SELECT endpoint, column_name, 'removed' AS change FROM (FROM before EXCEPT FROM after)
    WHERE endpoint IN (SELECT endpoint FROM after)""",
    "incremental_guard": _CLEAN
    + f""", guard AS (SELECT freq_code, max(period) AS newest FROM staged
      WHERE period[1:4] <= '{_SPLIT}' GROUP BY freq_code)
    SELECT s.freq_code, s.period, count(*) AS n_rows
    FROM staged s LEFT JOIN guard g ON s.freq_code = g.freq_code
    WHERE s.period >= coalesce(g.newest, '0000') GROUP BY s.freq_code, s.period""",
    "guard_reference": _CLEAN
    + f""" SELECT freq_code, period, count(*) AS n_rows FROM staged
    WHERE period >= (SELECT max(period) FROM staged WHERE period[1:4] <= '{_SPLIT}')
    GROUP BY freq_code, period""",
    "upsert_flows": _upserted(_flows, r.TRADE_FLOWS_KEY),
    "upsert_summary": _upserted(_summary, r.REPORTER_SUMMARY_KEY),
    "backfill_status": _backfill(),
    "silver_build": _CLEAN + _summary(),
    "validation_metrics": _RESULTS
    + """, per_run AS (SELECT endpoint, run_id, count(*) FILTER (WHERE passed) AS ok,
      count(*) FILTER (WHERE NOT passed) AS bad FROM results GROUP BY endpoint, run_id)
    SELECT endpoint, run_id, 'RowCount' AS metric, 'Count' AS unit, CAST(n AS DOUBLE) AS value
      FROM counts
    UNION ALL SELECT endpoint, run_id, 'ChecksPassed', 'Count', CAST(ok AS DOUBLE) FROM per_run
    UNION ALL SELECT endpoint, run_id, 'ChecksFailed', 'Count', CAST(bad AS DOUBLE) FROM per_run""",
    "runlog_status": """
    SELECT concat('phase-', user_id % 5) AS phase,
      count(*) FILTER (WHERE event_type = 'error' AND event_id % 50 <> 0) AS models_errored,
      count(*) FILTER (WHERE event_type = 'signup' AND event_id % 50 <> 0) AS tests_failed
    FROM events GROUP BY ALL""",
    "daily_sums": _with(_POINTS)
    + f""" SELECT day, metric, dims, CAST(sum(CAST(value AS {MONEY})) AS DOUBLE) AS total
    FROM points WHERE metric <> 'DbtRunDuration' GROUP BY day, metric, dims""",
    "failure_rate": _with(_POINTS)
    + f""" SELECT day, dims, CAST(coalesce(sum(CAST(value AS {MONEY}))
        FILTER (WHERE metric = 'ChecksFailed'), 0) AS DOUBLE)
      / nullif(CAST(sum(CAST(value AS {MONEY})) AS DOUBLE), 0.0::DOUBLE) * 100 AS failure_rate_pct
    FROM points WHERE metric IN ('ChecksPassed', 'ChecksFailed') GROUP BY day, dims""",
    "avg_duration": _with(_POINTS)
    + f""" SELECT day, metric, dims,
      CAST(sum(CAST(value AS {MONEY})) AS DOUBLE) / count(value) AS average
    FROM points WHERE metric = 'DbtRunDuration' GROUP BY day, metric, dims""",
    "scan_alarm": f"""
    SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, total FROM (
      SELECT time_bucket(INTERVAL '5 minutes', ts) AS w,
        CAST(sum(CAST(value AS {MONEY})) AS DOUBLE) AS total FROM events
      WHERE event_type = 'purchase' GROUP BY w)
    WHERE total > {r.ALARM_LIMIT}""",
    "lineage_edges": f"""
    WITH tasks AS (SELECT event_type, user_id, {_UUID} AS h FROM events WHERE event_type <> 'view')
    SELECT concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-',
        translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab'), h[18:20], '-', h[21:32]) AS run_id,
      concat('dag_', event_type, '.extract') AS job, input_namespace, input_name,
      's3://lake' AS output_namespace, concat('out/', event_type) AS output_name
    FROM (
      SELECT *, 'https://api.example.org' AS input_namespace,
        concat('/v1/', event_type) AS input_name FROM tasks
      UNION ALL
      SELECT *, 's3://lake', concat('in/', user_id) FROM tasks)""",
    "manifest_counts": _with(_MANIFESTS)
    + """ SELECT dag_id, task_id, exception_type, count(*) AS failures FROM manifests
    GROUP BY dag_id, task_id, exception_type""",
    "retention_kept": _with(_MANIFESTS)
    + f""" SELECT * EXCLUDE (ts) FROM manifests
    WHERE ts >= TIMESTAMP '{r.RETENTION_NOW[:19]}' - INTERVAL 90 DAY""",
    "pii_findings": "SELECT * FROM ("
    + _pii("documents", "doc_id", ("text", "lang", "source"))
    + " UNION ALL "
    + _pii("pages", "page_id", ("url", "html"))
    + ") WHERE n > 0",
}
