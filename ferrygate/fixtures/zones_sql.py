"""DuckDB statements of the queries in ``zones``."""

from __future__ import annotations

from . import zones as z
from .oracles import _BRONZE, _POINTS, _with

_LINES = f"""
lines AS (
  SELECT *, l_orderkey // {z.BLOCK} AS block, (l_orderkey // {z.BLOCK}) % {z.KINDS} AS kind,
    concat('block-', l_orderkey // {z.BLOCK}) AS run_id, CAST(year(l_shipdate) AS VARCHAR) AS period,
    CAST(l_suppkey % 25 AS VARCHAR) AS "reporterCode", CAST(l_partkey % 25 AS VARCHAR) AS "partnerCode",
    concat(l_orderkey, '-', l_linenumber) AS "cmdCode", CAST(trunc(l_quantity) AS BIGINT) AS quantity
  FROM lineitem),
blocks AS (
  SELECT block, kind, run_id, count(*) AS n, lpad(CAST(block % 12 + 1 AS VARCHAR), 2, '0') AS month
  FROM lines GROUP BY block, kind, run_id)"""
_READ = f"kind NOT IN ({z.CUT}, {z.BARE})"


def _is(kind: int) -> str:
    return f"kind = {kind}"


_CHECKS = ("no_nulls", "numeric_non_negative", "period_format", "no_duplicates")

_DIMS = """period, freqcode AS freq_code, typecode AS type_code, CAST(reportercode AS INTEGER) AS reporter_code,
    reporteriso AS reporter_iso, reporterdesc AS reporter_name, CAST(partnercode AS INTEGER) AS partner_code,
    partneriso AS partner_iso, partnerdesc AS partner_name, cmdcode AS commodity_code, cmddesc AS commodity_name,
    flowcode AS flow_code, flowdesc AS flow_name"""

ZONES_SQL = {
    "build_metrics": _with(_BRONZE)
    + """ SELECT metric, unit, phase, CASE WHEN unit = 'Seconds' THEN 1.0::DOUBLE
      ELSE CAST((SELECT count(*) FILTER (reportercode IS NULL OR period IS NULL OR primaryvalue < 0) FROM bronze) AS DOUBLE) END AS value
    FROM (VALUES ('DbtRunDuration', 'Seconds'), ('DbtModelsErrored', 'Count'), ('DbtTestsFailed', 'Count')) AS m(metric, unit),
      (VALUES ('freshness'), ('run'), ('test')) AS p(phase)""",
    "envelope_scan": _with(_LINES)
    + f""" SELECT 'preview' AS endpoint, run_id, 'C' AS type, 'A' AS freq, '2001' AS year, month,
      CASE WHEN {_is(z.CUT)} THEN NULL WHEN {_is(z.LIST)} THEN 'list' ELSE 'object' END AS kind,
      kind NOT IN ({z.CUT}, {z.BARE}, {z.LIST}) AS has_data, kind NOT IN ({z.CUT}, {z.BARE}, {z.LIST}) AS data_is_list,
      CASE WHEN kind IN ({z.CUT}, {z.LIST}) THEN NULL ELSE n END AS declared_count,
      CASE WHEN {_READ} THEN n ELSE 0 END AS n_records
    FROM blocks""",
    "raw_scan": _with(_LINES)
    + f""" SELECT 'preview' AS endpoint, 'C' AS type, 'A' AS freq, '2001' AS year, month, run_id
    FROM blocks WHERE month = '{z.MONTH}'""",
    "landing_round_trip": _with(_LINES)
    + f""" SELECT run_id, period, "reporterCode", "partnerCode", "cmdCode", quantity AS value FROM lines WHERE {_READ}""",
    "flat_parquet": _with(_LINES)
    + f""" SELECT run_id, "cmdCode", quantity, 'kg' AS unit FROM lines WHERE {_READ}""",
    "structural_checks": _with(
        _LINES,
        """
keys AS (
  SELECT run_id, count(*) - 1 AS more FROM lines GROUP BY run_id, "reporterCode", "partnerCode", "cmdCode", period),
repeats AS (SELECT run_id, sum(more) AS repeated FROM keys GROUP BY run_id)""",
    )
    + f""" SELECT 'preview' AS endpoint, run_id, 'check_envelope' AS name, NOT {_is(z.CUT)} AS passed, 'error' AS severity
      FROM blocks
    UNION ALL SELECT 'preview', run_id, 'check_has_data_key', {_READ}, 'error' FROM blocks
    UNION ALL SELECT 'preview', run_id, 'check_row_count', {_READ}, 'error' FROM blocks
    UNION ALL SELECT 'preview', run_id, concat('check_', name), name <> 'no_duplicates' OR repeated = 0,
        CASE WHEN name IN ('no_duplicates', 'numeric_non_negative') THEN 'warning' ELSE 'error' END
      FROM blocks JOIN repeats USING (run_id), unnest({list(_CHECKS)}) AS c(name) WHERE {_READ}""",
    "bronze_evolution": _with(_BRONZE)
    + """ SELECT period, CASE WHEN l_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS load_id, count(*) AS n,
      count(*) FILTER (l_orderkey % 2 = 0) AS with_flowdesc, count(*) FILTER (l_orderkey % 2 = 1) AS with_netweight
    FROM bronze GROUP BY ALL""",
    "backfill_rows": _with(_BRONZE)
    + f""" SELECT period, reportercode AS "reporterCode",
      count(*) + count(*) FILTER (reportercode = '{z.REPORTER}') AS n
    FROM bronze WHERE period = '{z.YEAR}' AND freqcode = 'A' GROUP BY period, reportercode""",
    "compaction": _with(_BRONZE)
    + """ SELECT period, count(*) AS n, CAST(1 AS BIGINT) AS files, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey
    FROM bronze GROUP BY period""",
    "stream_landing": _with(_LINES)
    + f""" SELECT period, "reporterCode", count(*) AS n, CAST(sum(quantity) AS BIGINT) AS value
    FROM lines WHERE {_READ} GROUP BY ALL""",
    "stream_alarm": _with(_POINTS)
    + f""" SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, total FROM (
      SELECT time_bucket(INTERVAL '5 minutes', ts) AS w, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) AS total
      FROM points WHERE metric = '{z.ALARM_METRIC}' GROUP BY w)
    WHERE total > {z.ALARM_LIMIT}
      AND w + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM points WHERE metric = '{z.ALARM_METRIC}') - INTERVAL 10 MINUTE""",
    "trade_flows_extreme": _with(
        _BRONZE,
        f"""valued AS (
  SELECT {_DIMS}, CASE WHEN l_orderkey % 1009 = 0 THEN 'inf'::DOUBLE WHEN l_orderkey % 5 = 1 THEN primaryvalue * 1e-12::DOUBLE
    WHEN l_orderkey % 5 = 2 THEN floor(primaryvalue) * pow(2.0::DOUBLE, 50) WHEN l_orderkey % 5 = 3 THEN primaryvalue * 1e-22::DOUBLE
    ELSE primaryvalue END AS v
  FROM bronze)""",
    )
    + """ SELECT * EXCLUDE (v), CASE WHEN max(v) = 'inf'::DOUBLE THEN 'infinite' ELSE printf('%.11e', fsum(v)) END AS trade_value_usd,
      count(*) AS source_record_count
    FROM valued WHERE v >= 0 GROUP BY ALL""",
}
