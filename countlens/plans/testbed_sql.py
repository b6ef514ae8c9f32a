"""Independent SQL (DuckDB dialect) for every query in ``testbed.QUERIES``.

Written the straightforward way (two scans plus join for the change
reports, window + filter for top-n) so that it checks the Spark plans rather
than restating them. Null ordering is spelled out because Spark and DuckDB
defaults differ.
"""

from __future__ import annotations

_DAY_TOP = """
WITH d AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS k, SUM(l_quantity) AS q
  FROM lineitem GROUP BY 1, 2),
r AS (
  SELECT d, k, q, ROW_NUMBER() OVER (
    PARTITION BY d ORDER BY q DESC NULLS LAST, k ASC NULLS FIRST) AS rk
  FROM d)
SELECT CAST(d AS VARCHAR) AS "date", CAST(rk AS INTEGER) AS "rank", k AS sensor_id,
       s_name AS location_name, CAST(q AS BIGINT) AS daily_count
FROM r LEFT JOIN supplier ON k = s_suppkey
WHERE rk <= {n}
"""

_MONTH_TOP = f"""
WITH t AS ({_DAY_TOP.format(n=10)}),
m AS (
  SELECT substr("date", 1, 7) AS year_month, sensor_id, SUM(daily_count) AS q
  FROM t GROUP BY 1, 2),
r AS (
  SELECT year_month, sensor_id, q, ROW_NUMBER() OVER (
    PARTITION BY year_month ORDER BY q DESC NULLS LAST, sensor_id ASC NULLS FIRST) AS rk
  FROM m)
SELECT year_month, CAST(rk AS INTEGER) AS "rank", sensor_id, s_name AS location_name,
       CAST(q AS BIGINT) AS monthly_count
FROM r LEFT JOIN supplier ON sensor_id = s_suppkey
WHERE rk <= 10
"""

_EVENTS_TOP = """
WITH d AS (
  SELECT CAST(ts AS DATE) AS d, user_id AS k, SUM(CAST(round(value * 100) AS BIGINT)) AS q
  FROM events GROUP BY 1, 2),
r AS (
  SELECT d, k, q, ROW_NUMBER() OVER (
    PARTITION BY d ORDER BY q DESC NULLS LAST, k ASC NULLS FIRST) AS rk
  FROM d)
SELECT CAST(d AS VARCHAR) AS "date", CAST(rk AS INTEGER) AS "rank", k AS sensor_id,
       c_name AS location_name, CAST(q AS BIGINT) AS daily_count
FROM r LEFT JOIN customer ON k = c_custkey
WHERE rk <= 10
"""

_TEXT_TOP = """
WITH d AS (
  SELECT CAST(l_shipdate AS DATE) AS d, CAST(l_suppkey AS INTEGER) AS k,
         SUM(CAST(l_quantity AS INTEGER)) AS q
  FROM lineitem GROUP BY 1, 2),
r AS (
  SELECT d, k, q, ROW_NUMBER() OVER (
    PARTITION BY d ORDER BY q DESC NULLS LAST, k ASC NULLS FIRST) AS rk
  FROM d)
SELECT CAST(d AS VARCHAR) AS "date", CAST(rk AS INTEGER) AS "rank", k AS sensor_id,
       s_name AS location_name, CAST(q AS BIGINT) AS daily_count
FROM r LEFT JOIN supplier ON k = s_suppkey
WHERE rk <= 10
"""


def _change(
    base, current, names, direction, key="l_suppkey", value="l_quantity", dim="supplier"
):
    b_out, c_out, ch_out, pct_out = names
    diff = "p - c" if direction == "decline" else "c - p"
    return f"""
WITH a AS (
  SELECT {key} AS k, CAST(SUM({value}) AS BIGINT) AS p FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '{base[0]}' AND l_shipdate < TIMESTAMP '{base[1]}'
  GROUP BY 1),
b AS (
  SELECT {key} AS k, CAST(SUM({value}) AS BIGINT) AS c FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '{current[0]}' AND l_shipdate < TIMESTAMP '{current[1]}'
  GROUP BY 1),
j AS (SELECT a.k, p, c FROM a JOIN b ON a.k = b.k)
SELECT j.k AS sensor_id, s_name AS location_name, p AS {b_out}, c AS {c_out},
       {diff} AS {ch_out},
       CASE WHEN p <> 0 THEN CAST({diff} AS DOUBLE) / CAST(p AS DOUBLE) * 100.0 END AS {pct_out}
FROM j LEFT JOIN {dim} ON j.k = s_suppkey
"""


_DECLINE_NAMES = ("count_2019", "count_2022", "decline", "decline_percent")
_GROWTH_NAMES = ("count_previous_year", "count_last_year", "growth", "growth_percent")
_BASE = ("1998-11-01", "1999-11-01")
_CURRENT = ("1999-11-01", "2000-11-01")
_LAST = ("2000-11-01", "2001-11-01")

_LABEL_MISS = """
WITH t AS (SELECT l_suppkey, CAST(SUM(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1),
s AS (SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 20)
SELECT l_suppkey AS sensor_id, total, s_name AS location_name
FROM t LEFT JOIN s ON l_suppkey = s_suppkey
"""

_COUNTS_VIEW = """
SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date_time,
       CAST(l_suppkey AS INTEGER) AS sensor_id,
       s_name AS sensor_name,
       CAST(l_quantity AS INTEGER) AS hourly_count
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
"""

_FORMATTED = """
SELECT
  CASE WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%d/%m/%Y')
       WHEN l_linenumber = 5 THEN NULL
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day_text,
  CASE WHEN l_linenumber = 1 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
       WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
       WHEN l_linenumber = 4 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.123+10:00')
       WHEN l_linenumber = 5 THEN NULL
       ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS time_text
FROM lineitem
"""

_DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
_ISO_OPT_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?([+-]\d{2}:\d{2}|Z)?$"
_ISO_REQ_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?([+-]\d{2}:\d{2}|Z)$"


def _row(table, column, check, failing_where, source="t"):
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(COUNT(*) FILTER (WHERE {failing_where}) AS BIGINT) AS failures FROM {source}"
    )


def _unique_row(table, column, source):
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'unique' AS check_name, "
        f"CAST((SELECT COUNT(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY 1 HAVING COUNT(*) > 1)) AS BIGINT) AS failures"
    )


def _union(*parts):
    return "\nUNION ALL\n".join(parts)


_TEXT_MONTH_TOP = f"""
WITH t AS ({_TEXT_TOP}),
m AS (
  SELECT substr("date", 1, 7) AS year_month, sensor_id, SUM(daily_count) AS q
  FROM t GROUP BY 1, 2),
r AS (
  SELECT year_month, sensor_id, q, ROW_NUMBER() OVER (
    PARTITION BY year_month ORDER BY q DESC NULLS LAST, sensor_id ASC NULLS FIRST) AS rk
  FROM m)
SELECT year_month, CAST(rk AS INTEGER) AS "rank", sensor_id, s_name AS location_name,
       CAST(q AS BIGINT) AS monthly_count
FROM r LEFT JOIN supplier ON sensor_id = s_suppkey
WHERE rk <= 10
"""

_REFERENCE_VIEW = """
SELECT CAST(s_suppkey AS INTEGER) AS location_id, s_name AS sensor_description,
       CAST(NULL AS VARCHAR) AS installation_date, 'Outdoor' AS location_type, 'A' AS status,
       CAST(NULL AS VARCHAR) AS direction_1, CAST(NULL AS VARCHAR) AS direction_2,
       s_acctbal AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude
FROM supplier
"""

_ACCEPTED_DIRECTIONS = "('North', 'South', 'East', 'West', 'In', 'Out')"

_DAY_TOTALS = """
SELECT CAST(l_shipdate AS DATE) AS "day", CAST(l_suppkey AS INTEGER) AS sensor_id,
       CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY 1, 2
"""

_DATA_TESTS = (
    f"WITH c AS ({_COUNTS_VIEW}), d AS ({_REFERENCE_VIEW}), r AS ({_TEXT_TOP})\n"
    + _union(
        _unique_row("sensor_counts", "id", "c"),
        _row("sensor_counts", "id", "not_null", "id IS NULL", "c"),
        _row("sensor_counts", "date_time", "not_null", "date_time IS NULL", "c"),
        _row("sensor_counts", "date_time", "is_iso_format",
             f"date_time IS NOT NULL AND NOT regexp_matches(date_time, '{_ISO_OPT_RE}')", "c"),
        _row("sensor_counts", "sensor_id", "not_null", "sensor_id IS NULL", "c"),
        _row("sensor_counts", "sensor_name", "not_null", "sensor_name IS NULL", "c"),
        _row("sensor_counts", "hourly_count", "not_null", "hourly_count IS NULL", "c"),
        _row("sensor_counts", "hourly_count", "non_negative", "hourly_count < 0", "c"),
        _row("sensor_counts", "sensor_id", "in_range", "sensor_id < 0 OR sensor_id >= 1000", "c"),
        _row("sensor_reference_data", "location_id", "not_null", "location_id IS NULL", "d"),
        _unique_row("sensor_reference_data", "location_id", "d"),
        _row("sensor_reference_data", "sensor_description", "not_null",
             "sensor_description IS NULL", "d"),
        _row("sensor_reference_data", "installation_date", "is_date_format",
             f"installation_date IS NOT NULL AND NOT regexp_matches(installation_date, '{_DATE_RE}')",
             "d"),
        _row("sensor_reference_data", "location_type", "not_null", "location_type IS NULL", "d"),
        _row("sensor_reference_data", "location_type", "accepted_values",
             "location_type IS NOT NULL AND location_type NOT IN "
             "('Indoor', 'Outdoor', 'Indoor Blix', 'Outdoor Blix')", "d"),
        _row("sensor_reference_data", "status", "not_null", "status IS NULL", "d"),
        _row("sensor_reference_data", "status", "accepted_values",
             "status IS NOT NULL AND status NOT IN ('A')", "d"),
        _row("sensor_reference_data", "direction_1", "accepted_values",
             f"direction_1 IS NOT NULL AND direction_1 NOT IN {_ACCEPTED_DIRECTIONS}", "d"),
        _row("sensor_reference_data", "direction_2", "accepted_values",
             f"direction_2 IS NOT NULL AND direction_2 NOT IN {_ACCEPTED_DIRECTIONS}", "d"),
        _row("sensor_reference_data", "latitude", "not_null", "latitude IS NULL", "d"),
        _row("sensor_reference_data", "longitude", "not_null", "longitude IS NULL", "d"),
        _row("report_top_10_locations_by_day", "date", "not_null", '"date" IS NULL', "r"),
        _row("report_top_10_locations_by_day", "date", "is_date_format",
             f"\"date\" IS NOT NULL AND NOT regexp_matches(\"date\", '{_DATE_RE}')", "r"),
        _row("report_top_10_locations_by_day", "rank", "not_null", '"rank" IS NULL', "r"),
        _row("report_top_10_locations_by_day", "rank", "rank_range",
             '"rank" IS NOT NULL AND "rank" NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)', "r"),
        _row("report_top_10_locations_by_day", "sensor_id", "not_null", "sensor_id IS NULL", "r"),
        _row("report_top_10_locations_by_day", "daily_count", "not_null",
             "daily_count IS NULL", "r"),
    )
)

_TEXT_DECLINE = _change(
    _BASE, _CURRENT, _DECLINE_NAMES, "decline",
    key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
)

_REFERENCE_JSON = """
SELECT CAST(s_suppkey AS INTEGER) AS location_id, s_name AS sensor_description,
       'S' || CAST(s_suppkey AS VARCHAR) AS sensor_name,
       CAST(NULL AS VARCHAR) AS installation_date,
       s_acctbal AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude,
       CAST(s_nationkey AS DOUBLE) AS location_lon, s_acctbal AS location_lat
FROM supplier
"""

_UNIQUE_ID = """((l_orderkey * 32768 + l_partkey) * 4096
  + date_diff('day', DATE '1994-01-01', CAST(l_shipdate AS DATE))) * 8 + l_linenumber"""
_BATCH_COUNTS = f"""
WITH u AS (SELECT CAST({_UNIQUE_ID} AS BIGINT) AS id, * FROM lineitem),
r AS (
  SELECT id, l_shipdate, l_suppkey, l_quantity AS q FROM u
  UNION ALL SELECT id, l_shipdate, l_suppkey, 0 FROM u WHERE l_linenumber <= 4 AND id % 211 = 8)
SELECT id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date_time, CAST(l_suppkey AS INTEGER) AS sensor_id,
       s_name AS sensor_name, CAST(q AS INTEGER) AS hourly_count, strftime(l_shipdate, '%Y-%m') AS year_month
FROM r LEFT JOIN supplier ON l_suppkey = s_suppkey
"""

ORACLE_SQL: dict[str, str] = {
    "top_n_by_day": _DAY_TOP.format(n=10),
    "top_n_by_month": _MONTH_TOP,
    "top_n_by_day_events": _EVENTS_TOP,
    "top_n_by_day_from_text": _TEXT_TOP,
    "decline_report": _change(_BASE, _CURRENT, _DECLINE_NAMES, "decline"),
    "decline_report_from_text": _change(
        _BASE, _CURRENT, _DECLINE_NAMES, "decline",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "decline_report_missing_labels": _change(
        _BASE, _CURRENT, _DECLINE_NAMES, "decline",
        dim="(SELECT * FROM supplier WHERE s_nationkey < 20)",
    ),
    "growth_report": _change(_CURRENT, _LAST, _GROWTH_NAMES, "growth"),
    "period_total_half_open": """
SELECT l_suppkey AS sensor_id, CAST(SUM(l_quantity) AS BIGINT) AS total FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1996-04-01'
GROUP BY 1
""",
    "label_left_join_miss": _LABEL_MISS,
    "reformat_datetime": """
SELECT l_orderkey, l_linenumber,
       strftime(l_shipdate, '%B %d, %Y %I:%M:%S %p') AS raw_text,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date_time,
       CAST(l_shipdate AS DATE) AS day
FROM lineitem
""",
    "ingest_counts_csv": _COUNTS_VIEW,
    "ingest_counts_stream": _COUNTS_VIEW,
    "ingest_reference_json": _REFERENCE_JSON,
    "overwrite_roundtrip": "SELECT * FROM supplier",
    "publish_roundtrip": "SELECT * FROM supplier",
    "passthrough_view": "SELECT * FROM nation",
    "preview": "SELECT * FROM supplier ORDER BY s_acctbal DESC NULLS LAST, s_suppkey ASC LIMIT 10",
    "check_not_null": f"WITH t AS ({_LABEL_MISS})\n"
    + _union(
        _row("label_left_join_miss", "sensor_id", "not_null", "sensor_id IS NULL"),
        _row("label_left_join_miss", "total", "not_null", "total IS NULL"),
        _row("label_left_join_miss", "location_name", "not_null", "location_name IS NULL"),
    ),
    "check_unique": _union(
        _unique_row("lineitem", "l_orderkey", "lineitem"),
        _unique_row("supplier", "s_suppkey", "supplier"),
    ),
    "check_accepted_values": _row(
        "customer", "c_mktsegment", "accepted_values",
        "c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')",
        source="customer",
    ),
    "check_date_format": f"WITH t AS ({_FORMATTED})\n"
    + _row("lineitem", "day_text", "is_date_format",
           f"day_text IS NOT NULL AND NOT regexp_matches(day_text, '{_DATE_RE}')"),
    "check_iso_format": f"WITH t AS ({_FORMATTED})\n"
    + _row("lineitem", "time_text", "is_iso_format",
           f"time_text IS NOT NULL AND NOT regexp_matches(time_text, '{_ISO_OPT_RE}')"),
    "check_iso_format_strict": f"WITH t AS ({_FORMATTED})\n"
    + _row("lineitem_strict", "time_text", "is_iso_format",
           f"time_text IS NOT NULL AND NOT regexp_matches(time_text, '{_ISO_REQ_RE}')"),
    "check_non_negative": _row(
        "customer", "c_acctbal", "non_negative", "c_acctbal < 0", source="customer"
    ),
    "check_id_range": _row(
        "supplier", "s_suppkey", "in_range", "s_suppkey < 0 OR s_suppkey >= 50", source="supplier"
    ),
    "check_rank_range": f"WITH t AS ({_DAY_TOP.format(n=12)})\n"
    + _union(
        _row("report_top_n_by_day", "date", "not_null", '"date" IS NULL'),
        _row("report_top_n_by_day", "date", "is_date_format",
             f"\"date\" IS NOT NULL AND NOT regexp_matches(\"date\", '{_DATE_RE}')"),
        _row("report_top_n_by_day", "rank", "not_null", '"rank" IS NULL'),
        _row("report_top_n_by_day", "rank", "rank_range",
             '"rank" IS NOT NULL AND "rank" NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)'),
        _row("report_top_n_by_day", "sensor_id", "not_null", "sensor_id IS NULL"),
        _row("report_top_n_by_day", "daily_count", "not_null", "daily_count IS NULL"),
    ),
    "sensor_counts_data_tests": f"WITH t AS ({_COUNTS_VIEW})\n"
    + _union(
        _unique_row("sensor_counts", "id", "t"),
        _row("sensor_counts", "id", "not_null", "id IS NULL"),
        _row("sensor_counts", "date_time", "not_null", "date_time IS NULL"),
        _row("sensor_counts", "date_time", "is_iso_format",
             f"date_time IS NOT NULL AND NOT regexp_matches(date_time, '{_ISO_OPT_RE}')"),
        _row("sensor_counts", "sensor_id", "not_null", "sensor_id IS NULL"),
        _row("sensor_counts", "sensor_name", "not_null", "sensor_name IS NULL"),
        _row("sensor_counts", "hourly_count", "not_null", "hourly_count IS NULL"),
        _row("sensor_counts", "hourly_count", "non_negative", "hourly_count < 0"),
        _row("sensor_counts", "sensor_id", "in_range", "sensor_id < 0 OR sensor_id >= 1000"),
    ),
    "violations_unique": """
SELECT l_orderkey, COUNT(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1
""",
    "violations_non_negative": "SELECT * FROM customer WHERE c_acctbal < 0",
    "stored_day_totals": _DAY_TOTALS,
    "stored_top_n_by_day": _TEXT_TOP,
    "stored_top_n_by_month": _TEXT_MONTH_TOP,
    "stored_decline_report": _change(
        _BASE, _CURRENT, _DECLINE_NAMES, "decline",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "ingest_counts_stream_by_month": f"""
SELECT *, substr(date_time, 1, 7) AS year_month FROM ({_COUNTS_VIEW})
""",
    "ingest_counts_by_month": f"""
SELECT *, substr(date_time, 1, 7) AS year_month FROM ({_COUNTS_VIEW})
""",
    "decline_report_month_pruned": _change(
        _BASE, _CURRENT, _DECLINE_NAMES, "decline",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "stored_growth_report": _change(
        _CURRENT, _LAST, _GROWTH_NAMES, "growth",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "incremental_day_totals": f"""
SELECT *, strftime("day", '%Y-%m') AS year_month FROM ({_DAY_TOTALS})
""",
    "incremental_top_n_by_day": _TEXT_TOP,
    "incremental_top_n_by_month": _TEXT_MONTH_TOP,
    "incremental_decline_report": _change(
        _BASE, _CURRENT, _DECLINE_NAMES, "decline",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "incremental_growth_report": _change(
        _CURRENT, _LAST, _GROWTH_NAMES, "growth",
        key="CAST(l_suppkey AS INTEGER)", value="CAST(l_quantity AS INTEGER)",
    ),
    "stored_data_tests": _DATA_TESTS,
    "incremental_data_tests": _DATA_TESTS,
    "ingest_counts_mixed_headers": _COUNTS_VIEW,
    "ingest_counts_wide_ids": f"SELECT * REPLACE (id + 3000000000 AS id) FROM ({_COUNTS_VIEW})",
    "ingest_counts_bad_lines": """
SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id,
       CASE WHEN l_linenumber NOT IN (2, 4) THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS date_time,
       CASE WHEN l_linenumber NOT IN (2, 4) THEN CAST(l_quantity AS INTEGER) END AS hourly_count,
       l_linenumber IN (2, 3) AS is_bad_line
FROM lineitem
""",
    # A late row replaces an earlier one of its month that has its id.
    "incremental_late_rows": f"""
WITH c AS (SELECT *, substr(date_time, 1, 7) AS year_month FROM ({_COUNTS_VIEW}))
SELECT * FROM c WHERE NOT (
  year_month = '1996-03' AND substr(date_time, 9, 2) < '15'
  AND id IN (SELECT id FROM c WHERE year_month = '1996-03' AND substr(date_time, 9, 2) >= '15'))
""",
    "violations_all_checks": f"""
WITH c AS (
  SELECT id, CASE WHEN id % 8 = 2 THEN substr(date_time, 1, 10) ELSE date_time END AS date_time,
         sensor_id, CASE WHEN id % 5 <> 0 THEN sensor_name END AS sensor_name, hourly_count - 3 AS hourly_count
  FROM ({_COUNTS_VIEW})),
f AS (
  SELECT *, 'date_time' AS column_name, 'is_iso_format' AS check_name FROM c WHERE NOT contains(date_time, 'T')
  UNION ALL SELECT *, 'sensor_name', 'not_null' FROM c WHERE sensor_name IS NULL
  UNION ALL SELECT *, 'hourly_count', 'non_negative' FROM c WHERE hourly_count < 0
  UNION ALL SELECT *, 'sensor_id', 'in_range' FROM c WHERE sensor_id < 0 OR sensor_id >= 1000)
SELECT id, date_time, hourly_count, column_name, check_name FROM f
""",
    "ingest_quarantine": """
WITH c AS (SELECT l_orderkey * 8 + l_linenumber AS id, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey),
r AS (
  SELECT concat_ws('; ', CASE WHEN id % 83 = 2 OR s_name IS NULL THEN 'empty Sensor_Name' END,
                   CASE WHEN id % 97 = 5 THEN 'malformed Date_Time' END,
                   CASE WHEN id % 89 = 3 THEN 'malformed Hourly_Counts' END) AS reason FROM c)
SELECT CASE WHEN reason <> '' THEN reason END AS reason, CAST(COUNT(*) AS BIGINT) AS n_lines FROM r GROUP BY 1
""",
    "incremental_corrected_file": _BATCH_COUNTS,
    "incremental_duplicates_taken_back": f"SELECT id, COUNT(*) AS n FROM ({_BATCH_COUNTS}) GROUP BY id HAVING COUNT(*) > 1",
    "incremental_batch_day_totals": f"""
SELECT CAST(date_time AS DATE) AS "day", substr(date_time, 1, 10) AS day_text, sensor_id,
       CAST(SUM(hourly_count) AS BIGINT) AS total, COUNT(*) AS n_rows, year_month
FROM ({_BATCH_COUNTS}) GROUP BY 1, 2, 3, 6
""",
    "incremental_ranking_by_day": _TEXT_TOP,
    "incremental_ranking_by_month": _TEXT_MONTH_TOP,
    "decline_report_bad_times": _TEXT_DECLINE,
    "stored_decline_report_bad_times": _TEXT_DECLINE,
    "incremental_decline_report_bad_times": _TEXT_DECLINE,
    "ingest_reference_json_split": _REFERENCE_JSON,
    "publish_expired": "SELECT * FROM supplier",
    "passthrough_view_permanent": "SELECT * FROM supplier",
    "ingest_reference_json_array": _REFERENCE_JSON,
    "top_n_by_day_ordered": _DAY_TOP.format(n=10),
    "stored_top_n_by_day_int": f'SELECT * REPLACE (CAST(daily_count AS INTEGER) AS daily_count) FROM ({_TEXT_TOP})',
    "top_1500_by_year": """
WITH t AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "year", l_orderkey, SUM(l_quantity) AS total FROM lineitem GROUP BY 1, 2),
r AS (
  SELECT *, CAST(ROW_NUMBER() OVER (
    PARTITION BY "year" ORDER BY total DESC NULLS LAST, l_orderkey ASC NULLS FIRST) AS INTEGER) AS "rank" FROM t)
SELECT * FROM r WHERE "rank" <= 1500
""",
    "ranks_of_hot_periods": """
WITH t AS (SELECT l_linestatus, l_orderkey, SUM(l_quantity) AS total FROM lineitem GROUP BY 1, 2),
r AS (
  SELECT *, CAST(ROW_NUMBER() OVER (
    PARTITION BY l_linestatus ORDER BY total DESC NULLS LAST, l_orderkey ASC NULLS FIRST) AS INTEGER) AS "rank" FROM t)
SELECT * FROM r WHERE "rank" <= 1000000
""",
    "period_total_midday_of_dates": """
SELECT l_suppkey AS sensor_id, CAST(SUM(l_quantity) AS BIGINT) AS total FROM lineitem
WHERE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) >= TIMESTAMP '1996-03-01 12:00:00'
  AND CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) < TIMESTAMP '1996-03-31 12:00:00'
GROUP BY 1
""",
    "check_formats_with_line_breaks": """
SELECT 'lineitem' AS table_name, 'day_text' AS column_name, 'is_date_format' AS check_name,
       CAST(COUNT(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS failures FROM lineitem
UNION ALL
SELECT 'lineitem', 'time_text', 'is_iso_format', CAST(COUNT(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) FROM lineitem
""",
    "violations_not_null": f"SELECT * FROM ({_LABEL_MISS}) WHERE location_name IS NULL",
    "violations_accepted_values":
        "SELECT * FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')",
    "violations_date_format": f"SELECT * FROM ({_FORMATTED}) WHERE NOT regexp_matches(day_text, '{_DATE_RE}')",
    "violations_iso_format": f"SELECT * FROM ({_FORMATTED}) WHERE NOT regexp_matches(time_text, '{_ISO_OPT_RE}')",
    "violations_id_range": "SELECT * FROM supplier WHERE s_suppkey < 0 OR s_suppkey >= 50",
    "violations_rank_range": f'SELECT * FROM ({_DAY_TOP.format(n=12)}) WHERE "rank" NOT BETWEEN 1 AND 10',
}
