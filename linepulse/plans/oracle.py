"""The same results in plain SQL, written against the supplied tables.

The SQL follows the definitions step by step: it joins whole histories and ranks
afterwards, where the Spark side reduces first.
"""

from __future__ import annotations

AS_OF = "DATE '2024-02-01'"
NOW = "TIMESTAMP '2024-02-01 00:00:00'"
MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"

PROFILE = """customer_id, full_name, email, date_of_birth, telephone_number, home_postcode,
    card_id, home_station"""
STATUS = """line_id, line_name, status_severity, status_severity_description,
    disruption_reason, disruption_description, affected_stops_json"""

PROFILES_CTE = """
profiles AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    c_name AS full_name,
    CASE WHEN c_custkey % 17 = 0 THEN concat('bad.', CAST(c_custkey AS VARCHAR))
         WHEN c_custkey % 19 = 0 THEN ''
         ELSE concat('user', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
    CASE WHEN c_custkey % 101 = 0 THEN DATE '2999-01-01'
         WHEN c_custkey % 103 = 0 THEN NULL
         WHEN c_custkey % 107 = 0 THEN DATE '1900-01-01'
         ELSE DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) END AS date_of_birth,
    concat('07', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS telephone_number,
    concat('AB', CAST(c_custkey % 20 + 1 AS VARCHAR), ' ',
           CAST(c_custkey % 9 + 1 AS VARCHAR), 'CD') AS home_postcode,
    lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS card_id,
    CASE WHEN c_custkey % 97 = 0 THEN NULL
         ELSE concat('Station ', CAST(c_nationkey AS VARCHAR)) END AS home_station,
    concat('[2024-01-0', CAST(c_custkey % 9 + 1 AS VARCHAR), ' | Staff] Spoke on ',
           CASE c_custkey % 4 WHEN 0 THEN concat('07', lpad(CAST(c_custkey AS VARCHAR), 9, '0'))
             WHEN 1 THEN c_name
             WHEN 2 THEN concat('user', CAST(c_custkey AS VARCHAR), '@example.com')
             ELSE concat('AB', CAST(c_custkey % 20 + 1 AS VARCHAR), ' ',
                         CAST(c_custkey % 9 + 1 AS VARCHAR), 'CD') END,
           '.', chr(10), chr(10),
           '[2024-01-1', CAST(c_custkey % 9 AS VARCHAR), ' | Customer] Alerts are useful.')
      AS customer_notes,
    CAST(DATE '2024-01-05' + CAST(c_custkey % 25 AS INTEGER) AS TIMESTAMP) AS _inserted_at,
    CAST(DATE '2024-01-05' + CAST(c_custkey % 25 AS INTEGER) AS TIMESTAMP) AS _updated_at
  FROM customer
)"""

STATUS_CTE = """
keyed_events AS (
  SELECT event_id AS row_id, event_type AS line_id,
    concat('Station ', CAST(user_id % 25 AS VARCHAR)) AS station_name,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts
  FROM events
),
severe_events AS (
  SELECT *, CASE WHEN k = 99 THEN -1 ELSE k % 21 END AS status_severity FROM keyed_events
),
status AS (
  SELECT row_id, line_id, concat('Line ', upper(line_id)) AS line_name, station_name,
    status_severity,
    CASE WHEN status_severity < 0 THEN 'Unknown' WHEN status_severity < 4 THEN 'Severe'
         WHEN status_severity < 10 THEN 'Minor' WHEN status_severity = 10 THEN 'Good Service'
         ELSE 'Other' END AS status_severity_description,
    CASE WHEN status_severity = 10 THEN ''
         ELSE concat('reason ', CAST(row_id % 7 AS VARCHAR)) END AS disruption_reason,
    CASE WHEN status_severity = 10 THEN ''
         ELSE concat('detail ', CAST(row_id % 13 AS VARCHAR)) END AS disruption_description,
    concat('["', station_name, '"]') AS affected_stops_json,
    ts AS _inserted_at, ts AS _updated_at
  FROM severe_events
)"""

BRONZE_CTE = """
bronze AS (
  SELECT *, _inserted_at + INTERVAL 730 DAY AS _delete_at,
    concat('{"line_id":"', line_id, '","line_name":"', line_name, '","status_severity":',
           CAST(status_severity AS VARCHAR), ',"status_severity_description":"',
           status_severity_description, '","disruption_reason":"', disruption_reason,
           '","disruption_description":"', disruption_description, '","affected_stops_json":"',
           replace(affected_stops_json, '"', '\\"'), '","station_name":"', station_name,
           '","_inserted_at":"', strftime(_inserted_at, '%Y-%m-%dT%H:%M:%S.%g'),
           '","_updated_at":"', strftime(_updated_at, '%Y-%m-%dT%H:%M:%S.%g'), '"}') AS raw_payload
  FROM status
)"""

BRONZE_COLUMNS = f"raw_payload, station_name, {STATUS}, _inserted_at, _updated_at, _delete_at"


def joined(name: str, status: str) -> str:
    """All customers with all disrupted rows of their station."""
    return f"""
{name} AS (
  SELECT {PROFILE}, {STATUS},
    least(p._inserted_at, s._inserted_at) AS _inserted_at,
    least(p._updated_at, s._updated_at) AS _updated_at,
    s._updated_at AS _status_updated_at, s.row_id AS _status_row
  FROM profiles p JOIN {status} s ON p.home_station = s.station_name
  WHERE s.status_severity < 10
)"""


def newest(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, line_id
      ORDER BY _updated_at DESC, _status_updated_at DESC, _status_row DESC) AS rn
    FROM {source}) ranked
  WHERE rn = 1
)"""


def checked(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {PROFILE}, {STATUS}, _inserted_at, _updated_at, _status_updated_at, _status_row,
    CAST(date_sub('year', date_of_birth, {AS_OF}) AS INTEGER) AS age,
    CAST({AS_OF} + 365 AS TIMESTAMP) AS _delete_at
  FROM {source}
  WHERE home_station IS NOT NULL
    AND regexp_matches(email, '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$')
    AND date_of_birth < {AS_OF} AND date_of_birth > DATE '1900-01-01'
)"""


JOURNEYS_CTE = ",".join(
    [
        PROFILES_CTE,
        STATUS_CTE,
        joined("pairs", "status"),
        checked("good_pairs", "pairs"),
        newest("versions", "good_pairs"),
        """
journeys AS (SELECT * EXCLUDE (_status_updated_at, _status_row) FROM versions)""",
    ]
)

SUMMARY_KEYS = "line_id, line_name, disruption_date, status_severity_description"

SUMMARY_CTE = f"""{JOURNEYS_CTE},
dated AS (SELECT *, CAST(_updated_at AS DATE) AS disruption_date FROM journeys),
described AS (
  SELECT {SUMMARY_KEYS}, disruption_description,
    row_number() OVER (PARTITION BY {SUMMARY_KEYS}
      ORDER BY _updated_at DESC, home_station DESC, disruption_description DESC) AS rn
  FROM dated
),
grouped AS (
  SELECT {SUMMARY_KEYS}, count(customer_id) AS affected_customers,
    count(DISTINCT home_station) AS affected_stations,
    max(_updated_at) AS last_updated, min(_inserted_at) AS _inserted_at,
    min(_updated_at) AS _updated_at, CAST({AS_OF} + 730 AS TIMESTAMP) AS _delete_at
  FROM dated GROUP BY {SUMMARY_KEYS}
),
summary AS (
  SELECT g.*, d.disruption_description FROM grouped g JOIN described d
    USING (line_id, line_name, disruption_date, status_severity_description) WHERE d.rn = 1
)"""

TARGETS_CTE = f"""{JOURNEYS_CTE},
targets AS (
  SELECT customer_id, full_name, email, home_station, line_id, line_name,
    status_severity_description, disruption_reason, disruption_description,
    _inserted_at, _updated_at, CAST({AS_OF} + 365 AS TIMESTAMP) AS _delete_at
  FROM journeys
)"""

MAPPING_CTE = """
mapping AS (
  SELECT DISTINCT station_name, line_id FROM status
  UNION
  SELECT concat('Station ', CAST(n_nationkey AS VARCHAR)), lower(r_name)
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

# What a line's record says, or the defaults when there is no record.
RECORD_FIELDS = """
    coalesce(r.line_name, m.line_id) AS line_name,
    coalesce(r.status_severity, -1) AS status_severity,
    coalesce(r.status_severity_description, 'Unknown') AS status_severity_description,
    coalesce(r.disruption_reason, '') AS disruption_reason,
    coalesce(r.disruption_description, '') AS disruption_description,
    CASE WHEN r.line_id IS NULL THEN '[]' ELSE r.affected_stops_json END AS affected_stops_json"""

RULE_FAILURES = f"""
    SELECT count(*) AS rows,
      count(*) FILTER (WHERE home_station IS NULL) AS no_station,
      count(*) FILTER (WHERE NOT coalesce(regexp_matches(email,
        '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$'), false)) AS bad_email,
      count(*) FILTER (WHERE NOT coalesce(date_of_birth < {AS_OF}
        AND date_of_birth > DATE '1900-01-01', false)) AS bad_birth
    FROM profiles"""


def over(ctes: str, body: str) -> str:
    return f"WITH {ctes}{body}" if body.startswith(",") else f"WITH {ctes}\n{body}"


def of_profiles(body: str) -> str:
    return over(PROFILES_CTE, body)


def of_status(body: str) -> str:
    return over(STATUS_CTE, body)


def of_bronze(body: str) -> str:
    return over(f"{STATUS_CTE},{BRONZE_CTE}", body)


def of_journeys(body: str) -> str:
    return over(JOURNEYS_CTE, body)


def of_summary(body: str) -> str:
    return over(SUMMARY_CTE, body)


def of_targets(body: str) -> str:
    return over(TARGETS_CTE, body)


LATEST_PAIRS = ",".join([PROFILES_CTE, STATUS_CTE, joined("pairs", "status"), newest("latest", "pairs")])

SHIFTED = f"""
  _inserted_at + ({NOW} - (SELECT max(_inserted_at) FROM bronze)) AS _inserted_at,
  _updated_at + ({NOW} - (SELECT max(_inserted_at) FROM bronze)) AS _updated_at,
  _inserted_at + ({NOW} - (SELECT max(_inserted_at) FROM bronze)) + INTERVAL 730 DAY AS _delete_at"""

EMAIL_ANYWHERE = "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
PHONE_ANYWHERE = "(\\+44( ?\\(0\\))?|\\(?\\b0)([ ()\\-]{0,2}[0-9]){9,10}\\b"
POSTCODE_ANYWHERE = "\\b[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}\\b"


def scan(source: str, column: str, name: str, tagged: bool = False) -> str:
    parts = []
    for tag, pattern in (
        ("class.email_address", EMAIL_ANYWHERE),
        ("class.phone_number", PHONE_ANYWHERE),
        ("class.location", POSTCODE_ANYWHERE),
    ):
        hits = f"count(*) FILTER (WHERE regexp_matches({column}, '{pattern}'))"
        proposed = "false" if tagged else f"{hits} > 0"
        parts.append(
            f"SELECT '{name}' AS column_name, '{tag}' AS tag, count({column}) AS rows, "
            f"{hits} AS matches, {proposed} AS proposed FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def profiled(source: str, ts: str, column: str, numeric: bool) -> str:
    mean = f"avg({column})" if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT CAST(CAST({ts} AS DATE) AS TIMESTAMP) AS window_start, count(*) AS rows,
  '{column}' AS column_name, count(*) - count({column}) AS nulls,
  count(DISTINCT {column}) AS distinct_values, CAST(min({column}) AS VARCHAR) AS min_value,
  CAST(max({column}) AS VARCHAR) AS max_value, {mean} AS mean_value
FROM {source} GROUP BY CAST(CAST({ts} AS DATE) AS TIMESTAMP)"""


WEEK = "time_bucket(INTERVAL 7 DAY, _updated_at, TIMESTAMP '1970-01-01')"
WEEKLY_SKETCHES = "\nUNION ALL\n".join(
    f"""SELECT {WEEK} AS window_start, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
  CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
  {f"avg({c})" if c in ("status_severity", "age") else "CAST(NULL AS DOUBLE)"} AS mean_value,
  true AS distinct_within_error, true AS quantiles_in_order
FROM journeys GROUP BY {WEEK}"""
    for c in f"{PROFILE}, {STATUS}, _inserted_at, _updated_at, age, _delete_at".replace(",", " ").split()
)

JOURNEY_PROFILE = "\nUNION ALL\n".join(
    profiled("journeys", "_updated_at", c, c in ("status_severity", "age"))
    for c in f"{PROFILE}, {STATUS}, _inserted_at, _updated_at, age, _delete_at".replace(",", " ").split()
)

BY_LINE = """SELECT line_name, CAST(sum(affected_customers) AS BIGINT) AS total_affected_customers,
  count(*) AS disruption_events FROM summary GROUP BY line_name"""
DAILY = """SELECT disruption_date, CAST(sum(affected_customers) AS BIGINT) AS affected_customers,
  count(DISTINCT line_id) AS lines_disrupted FROM summary GROUP BY disruption_date"""
BY_SEVERITY = """SELECT status_severity_description,
  CAST(sum(affected_customers) AS BIGINT) AS affected_customers
FROM summary GROUP BY status_severity_description"""
STATIONS = """SELECT home_station, count(DISTINCT customer_id) AS affected_customers,
  count(DISTINCT line_id) AS disrupted_lines
FROM targets GROUP BY home_station ORDER BY affected_customers DESC, home_station LIMIT 20"""

ALL_JOURNEYS = of_journeys("SELECT * FROM journeys")
ALL_BRONZE = of_bronze(f"SELECT {BRONZE_COLUMNS} FROM bronze")

ORACLES: dict[str, str] = {
    "scan_static": of_profiles("SELECT * FROM profiles"),
    "scan_stream": of_status(
        "SELECT row_id, line_id, station_name, status_severity, _updated_at FROM status"
    ),
    "flatten_status": over(
        f"{STATUS_CTE},{MAPPING_CTE}",
        f""",
hourly AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, date_trunc('hour', _updated_at) AS run_ts,
      row_number() OVER (PARTITION BY date_trunc('hour', _updated_at), line_id
        ORDER BY _updated_at DESC, row_id DESC) AS rn
    FROM status) ranked WHERE rn = 1
),
runs AS (SELECT DISTINCT run_ts FROM hourly)
SELECT CASE WHEN r.line_id IS NULL THEN '{{}}' ELSE concat(
    '{{"id":"', r.line_id, '","name":"', r.line_name,
    '","lineStatuses":[{{"statusSeverity":', CAST(r.status_severity AS VARCHAR),
    ',"statusSeverityDescription":"', r.status_severity_description,
    '","reason":"', r.disruption_reason,
    '","disruption":{{"description":"', r.disruption_description,
    '","affectedStops":[{{"commonName":null,"name":"', r.station_name, '"}}]}}}}]}}')
    END AS raw_payload,
  m.station_name, m.line_id, {RECORD_FIELDS},
  runs.run_ts AS _inserted_at, runs.run_ts AS _updated_at,
  runs.run_ts + INTERVAL 730 DAY AS _delete_at
FROM runs CROSS JOIN mapping m
LEFT JOIN hourly r ON r.run_ts = runs.run_ts AND r.line_id = m.line_id""",
    ),
    "records_to_bronze": of_bronze(
        f"""SELECT * EXCLUDE (row_id) REPLACE (
  CASE WHEN row_id % 50 <> 0 THEN status_severity END AS status_severity,
  CASE WHEN row_id % 50 <> 0 THEN _updated_at END AS _updated_at)
FROM (SELECT row_id, {BRONZE_COLUMNS} FROM bronze) b"""
    ),
    "keep_raw_payload": of_profiles(
        f"""SELECT {PROFILE}, customer_notes, concat(
  '{{"customer_id":"', customer_id, '","full_name":"', full_name, '","email":"', email,
  '","date_of_birth":', coalesce('"' || CAST(date_of_birth AS VARCHAR) || '"', 'null'),
  ',"telephone_number":"', telephone_number, '","home_postcode":"', home_postcode,
  '","card_id":"', card_id,
  '","home_station":', coalesce('"' || home_station || '"', 'null'),
  ',"customer_notes":"', replace(customer_notes, chr(10), '\\n'), '"}}') AS raw_payload
FROM profiles"""
    ),
    "stamp_platform_cols": of_profiles(
        f"""SELECT customer_id, {NOW} AS _inserted_at, {NOW} AS _updated_at,
  {NOW} + INTERVAL 730 DAY AS _delete_at FROM profiles"""
    ),
    "create_table_idempotent": ALL_BRONZE,
    "reconcile_properties": of_bronze(
        "SELECT line_id, count(*) AS rows, '30m' AS freshness_sla FROM bronze GROUP BY line_id"
    ),
    "append_sink": ALL_BRONZE,
    "overwrite_sink": of_profiles(
        f"""SELECT {PROFILE}, customer_notes, _inserted_at, _updated_at,
  _inserted_at + INTERVAL 730 DAY AS _delete_at, concat(
  '{{"customer_id":"', customer_id, '","full_name":"', full_name, '","email":"', email,
  '","date_of_birth":', coalesce('"' || CAST(date_of_birth AS VARCHAR) || '"', 'null'),
  ',"telephone_number":"', telephone_number, '","home_postcode":"', home_postcode,
  '","card_id":"', card_id,
  '","home_station":', coalesce('"' || home_station || '"', 'null'),
  ',"customer_notes":"', replace(customer_notes, chr(10), '\\n'), '"}}') AS raw_payload
FROM profiles"""
    ),
    "snapshot_export": of_bronze(f"SELECT row_id, {BRONZE_COLUMNS} FROM bronze"),
    "snapshot_reload": of_bronze(
        f"SELECT raw_payload, station_name, {STATUS}, {SHIFTED} FROM bronze"
    ),
    "time_shift": of_bronze(
        f"SELECT row_id, raw_payload, station_name, {STATUS}, {SHIFTED} FROM bronze"
    ),
    "reload_guard": """
SELECT count(*) AS rows, 'plain' AS mode, CASE WHEN count(*) > 0 THEN 'error' ELSE 'load' END AS outcome FROM events
UNION ALL
SELECT count(*), 'quiet', CASE WHEN count(*) > 0 THEN 'skip' ELSE 'load' END FROM events
UNION ALL
SELECT count(*), 'force', 'load' FROM events""",
    "filter_disrupted": of_status(
        "SELECT row_id, line_id, station_name, status_severity FROM status WHERE status_severity < 10"
    ),
    "project_journey": over(
        LATEST_PAIRS, f"SELECT {PROFILE}, {STATUS}, _inserted_at, _updated_at FROM latest"
    ),
    "project_notification": of_targets("SELECT * EXCLUDE (_delete_at) FROM targets"),
    "filter_not_null": of_profiles(
        "SELECT customer_id, home_station FROM profiles WHERE home_station IS NOT NULL"
    ),
    "filter_email_valid": of_profiles(
        "SELECT customer_id, email FROM profiles WHERE regexp_matches(email, "
        "'^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}$')"
    ),
    "filter_dob_plausible": of_profiles(
        f"""SELECT customer_id, date_of_birth FROM profiles
WHERE date_of_birth < {AS_OF} AND date_of_birth > DATE '1900-01-01'"""
    ),
    "filter_recent_days": of_summary(
        f"""SELECT {SUMMARY_KEYS}, affected_customers FROM summary
WHERE disruption_date >= {AS_OF} - INTERVAL 30 DAY"""
    ),
    "filter_known_lines": of_status(
        """SELECT row_id, line_id FROM status
WHERE line_id IN ('click', 'error', 'purchase', 'signup')"""
    ),
    "join_profiles_status": over(
        LATEST_PAIRS,
        """SELECT customer_id, home_station, line_id, status_severity, _inserted_at, _updated_at,
  _status_updated_at, _status_row FROM latest""",
    ),
    "join_fanout": over(
        f"{PROFILES_CTE},{STATUS_CTE},{joined('pairs', 'status')}",
        """SELECT home_station AS station_name, line_id, count(*) AS pairs
FROM pairs GROUP BY home_station, line_id""",
    ),
    "lookup_line_status": over(
        f"{STATUS_CTE},{MAPPING_CTE}",
        f""",
newest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY _updated_at DESC, row_id DESC) AS rn
    FROM status) ranked WHERE rn = 1
)
SELECT m.station_name, m.line_id, {RECORD_FIELDS}
FROM mapping m LEFT JOIN newest r ON r.line_id = m.line_id""",
    ),
    "latest_then_join": ALL_JOURNEYS,
    "disruption_summary": of_summary("SELECT * FROM summary"),
    "agg_count_nonnull": of_summary(f"SELECT {SUMMARY_KEYS}, affected_customers FROM summary"),
    "agg_count_distinct": of_summary(f"SELECT {SUMMARY_KEYS}, affected_stations FROM summary"),
    "agg_first": of_summary(f"SELECT {SUMMARY_KEYS}, disruption_description FROM summary"),
    "agg_max": of_summary(f"SELECT {SUMMARY_KEYS}, last_updated FROM summary"),
    "agg_min": of_summary(f"SELECT {SUMMARY_KEYS}, _inserted_at, _updated_at FROM summary"),
    "count_rows": "SELECT count(*) AS rows FROM events",
    "q_disruptions_by_line": of_summary(
        f"{BY_LINE} ORDER BY total_affected_customers DESC, line_name"
    ),
    "q_daily_customer_impact": of_summary(f"{DAILY} ORDER BY disruption_date"),
    "q_severity_distribution": of_summary(
        f"{BY_SEVERITY} ORDER BY affected_customers DESC, status_severity_description"
    ),
    "q_customers_to_alert": of_targets(
        """SELECT line_name, line_id, disruption_reason,
  count(DISTINCT customer_id) AS customers_to_alert
FROM targets GROUP BY line_name, line_id, disruption_reason
ORDER BY customers_to_alert DESC, line_id, line_name, disruption_reason"""
    ),
    "q_affected_stations": of_targets(STATIONS),
    "q_scorecard_30d": of_summary(
        f"""SELECT count(*) AS total_disruption_events,
  CAST(sum(affected_customers) AS BIGINT) AS total_affected_customers,
  count(DISTINCT line_id) AS distinct_lines_disrupted
FROM summary WHERE disruption_date >= {AS_OF} - INTERVAL 30 DAY"""
    ),
    "q_notification_counter": of_targets(
        "SELECT count(DISTINCT customer_id) AS customers_to_notify FROM targets"
    ),
    "w_events_by_line": of_summary(
        f"""SELECT line_name, CAST(sum(disruption_events) AS BIGINT) AS disruption_events
FROM ({BY_LINE}) q GROUP BY line_name ORDER BY disruption_events DESC, line_name"""
    ),
    "w_daily_trend": of_summary(
        f"""SELECT disruption_date, CAST(sum(affected_customers) AS BIGINT) AS affected_customers,
  CAST(sum(lines_disrupted) AS BIGINT) AS lines_disrupted
FROM ({DAILY}) q GROUP BY disruption_date ORDER BY disruption_date"""
    ),
    "w_severity_breakdown": of_summary(
        f"""SELECT status_severity_description,
  CAST(sum(affected_customers) AS BIGINT) AS affected_customers
FROM ({BY_SEVERITY}) q GROUP BY status_severity_description
ORDER BY affected_customers DESC, status_severity_description"""
    ),
    "sort_desc": of_summary(
        f"{BY_SEVERITY} ORDER BY affected_customers DESC, status_severity_description"
    ),
    "sort_asc_date": of_summary(f"{DAILY} ORDER BY disruption_date"),
    "top_k_stations": of_targets(STATIONS),
    "fn_age_years": of_profiles(
        f"""SELECT customer_id, date_of_birth,
  CASE WHEN date_of_birth > {AS_OF}
       THEN CAST(-ceil(date_diff('month', {AS_OF}, date_of_birth) / 12.0) AS INTEGER)
       ELSE CAST(date_sub('year', date_of_birth, {AS_OF}) AS INTEGER) END AS age
FROM profiles"""
    ),
    "fn_retention_stamp": """SELECT o_orderkey,
  CAST(CAST(o_orderdate AS DATE) + 365 AS TIMESTAMP) AS _delete_at FROM orders""",
    "fn_oldest_of": of_status(
        """SELECT row_id, least(_updated_at, CASE WHEN row_id % 10 <> 0
  THEN date_trunc('day', _updated_at) + INTERVAL 12 HOUR END) AS oldest FROM status"""
    ),
    "fn_to_date": of_status(
        "SELECT row_id, CAST(_updated_at AS DATE) AS disruption_date FROM status"
    ),
    "fn_cast": of_status(
        """SELECT row_id,
  TRY_CAST(concat('2024-01-', lpad(CAST(row_id % 40 AS VARCHAR), 2, '0')) AS DATE) AS as_date,
  CASE WHEN row_id % 9 <> 0 THEN status_severity END AS as_int,
  TRY_CAST(concat('2024-01-', lpad(CAST(row_id % 40 AS VARCHAR), 2, '0'), ' 10:30:00')
    AS TIMESTAMP) AS as_timestamp
FROM status"""
    ),
    "fn_json_write": of_status(
        """SELECT row_id, concat('{"line_id":"', line_id, '","reason":',
  CASE WHEN row_id % 5 <> 0 THEN concat('"', disruption_reason, '"') ELSE 'null' END,
  ',"status_severity":', CAST(status_severity AS VARCHAR),
  ',"stops":["', station_name, '"]}') AS record FROM status"""
    ),
    "fn_json_navigate": of_status(
        """SELECT row_id, line_name, status_severity, status_severity_description,
  disruption_reason, disruption_description, affected_stops_json FROM status"""
    ),
    "fn_array_map": of_status(
        """SELECT row_id, concat('["', CASE WHEN row_id % 3 <> 0 THEN concat(station_name, ' Stop')
  WHEN row_id % 7 <> 0 THEN station_name ELSE '' END, '","', line_name, '"]') AS stops
FROM status"""
    ),
    "fn_rlike": of_profiles(
        "SELECT customer_id, regexp_matches(email, "
        "'^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}$') AS valid FROM profiles"
    ),
    "fn_in_list": of_status(
        "SELECT row_id, line_id IN ('click', 'error', 'purchase', 'signup') AS known FROM status"
    ),
    "fn_interval_sub": of_status(
        """SELECT row_id,
  CAST(_updated_at AS DATE) >= DATE '2024-02-14' - INTERVAL 30 DAY AS recent FROM status"""
    ),
    "fn_ts_add": of_status(
        """SELECT row_id, _inserted_at + INTERVAL 730 DAY AS fixed_days,
  _inserted_at + to_days(CAST(row_id % 30 AS INTEGER)) AS own_days FROM status"""
    ),
    "expect_warn": of_summary(
        f"""SELECT {SUMMARY_KEYS}, affected_customers,
  count(*) FILTER (WHERE disruption_date IS NULL) OVER () AS disruption_date_not_null_failed,
  count(*) FILTER (WHERE NOT coalesce(line_id IN ('click', 'error', 'purchase', 'signup'), false))
    OVER () AS valid_line_id_failed
FROM summary"""
    ),
    "expect_drop": of_profiles(
        f"""SELECT {PROFILE} FROM profiles WHERE home_station IS NOT NULL
  AND regexp_matches(email, '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$')
  AND date_of_birth < {AS_OF} AND date_of_birth > DATE '1900-01-01'"""
    ),
    "expect_drop_reasons": of_profiles(
        f"""SELECT * FROM (
  SELECT customer_id, concat_ws(',',
    CASE WHEN home_station IS NOT NULL THEN NULL ELSE 'home_station_not_null' END,
    CASE WHEN regexp_matches(email, '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$')
      THEN NULL ELSE 'valid_email' END,
    CASE WHEN date_of_birth < {AS_OF} AND date_of_birth > DATE '1900-01-01'
      THEN NULL ELSE 'plausible_birth' END) AS broken_rules
  FROM profiles) r WHERE broken_rules != ''"""
    ),
    "dq_report": of_profiles(
        f"""SELECT rule, rows, failed, failed / CAST(rows AS DOUBLE) AS failed_fraction FROM (
  SELECT 'home_station_not_null' AS rule, rows, no_station AS failed FROM ({RULE_FAILURES}) a
  UNION ALL SELECT 'valid_email', rows, bad_email FROM ({RULE_FAILURES}) b
  UNION ALL SELECT 'plausible_birth', rows, bad_birth FROM ({RULE_FAILURES}) c) r"""
    ),
    "scd1_upsert": ALL_JOURNEYS,
    "stream_journeys": ALL_JOURNEYS,
    "stream_notifications": of_targets("SELECT * FROM targets"),
    "changed_rows_feed": over(
        ",".join(
            [
                JOURNEYS_CTE,
                f"""
earlier_pairs AS (SELECT * FROM good_pairs WHERE _status_updated_at < {MIDDLE})""",
                newest("earlier", "earlier_pairs"),
            ]
        ),
        """SELECT CASE WHEN e.customer_id IS NULL THEN 'insert' ELSE 'update' END AS _change_type,
  j.customer_id, j.line_id, j.status_severity, j.disruption_reason, j._updated_at
FROM journeys j LEFT JOIN earlier e ON e.customer_id = j.customer_id AND e.line_id = j.line_id
WHERE e.customer_id IS NULL
  OR (e.status_severity, e.status_severity_description, e.disruption_reason,
      e.disruption_description, e._inserted_at, e._updated_at)
     IS DISTINCT FROM
     (j.status_severity, j.status_severity_description, j.disruption_reason,
      j.disruption_description, j._inserted_at, j._updated_at)""",
    ),
    "mask_name": of_profiles("SELECT customer_id, '***MASKED***' AS full_name FROM profiles"),
    "mask_email": of_profiles(
        "SELECT customer_id, regexp_replace(email, '[^@.]', '*', 'g') AS email FROM profiles"
    ),
    "mask_dob": of_profiles(
        """SELECT customer_id, CAST(date_trunc('year', date_of_birth) AS DATE) AS date_of_birth
FROM profiles"""
    ),
    "mask_postcode": of_profiles(
        "SELECT customer_id, split_part(home_postcode, ' ', 1) AS home_postcode FROM profiles"
    ),
    "mask_for_audience": of_journeys(
        """SELECT customer_id, '***MASKED***' AS full_name,
  regexp_replace(email, '[^@.]', '*', 'g') AS email,
  CAST(date_trunc('year', date_of_birth) AS DATE) AS date_of_birth, telephone_number,
  split_part(home_postcode, ' ', 1) AS home_postcode, card_id, home_station, line_id
FROM journeys"""
    ),
    "tag_columns": of_targets(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{tag}' AS tag, "
            f"count(*) AS rows, count({column}) AS non_null FROM {source}"
            for name, source, column, tag in (
                ("customer_journeys", "journeys", "full_name", "class.name"),
                ("customer_journeys", "journeys", "email", "class.email_address"),
                ("customer_journeys", "journeys", "date_of_birth", "class.date_of_birth"),
                ("customer_journeys", "journeys", "home_postcode", "class.location"),
                ("notification_targets", "targets", "full_name", "class.name"),
                ("notification_targets", "targets", "email", "class.email_address"),
            )
        )
    ),
    "pii_scan": of_profiles(
        "\nUNION ALL\n".join(
            [
                scan("profiles", "email", "email", tagged=True),
                scan("profiles", "telephone_number", "telephone_number"),
                scan("profiles", "home_postcode", "home_postcode"),
                scan("profiles", "customer_notes", "customer_notes"),
                scan("documents", "text", "documents_text"),
                scan("conversations", "text", "conversations_text"),
            ]
        )
    ),
    "notes_explode": of_profiles(
        """SELECT customer_id, CAST(pos AS INTEGER) AS pos,
  CAST(substr(entry, 2, 10) AS DATE) AS note_date,
  regexp_extract(entry, '\\| ([A-Za-z]+)\\]', 1) AS author,
  substr(entry, strpos(entry, '] ') + 2) AS note_text
FROM (
  SELECT customer_id, pos, split_part(customer_notes, chr(10) || chr(10), pos + 1) AS entry
  FROM profiles CROSS JOIN (VALUES (0), (1)) AS v(pos)) e"""
    ),
    "notes_own_pii": of_profiles(
        """SELECT customer_id, CAST(pos AS INTEGER) AS pos,
  CAST(substr(entry, 2, 10) AS DATE) AS note_date,
  regexp_extract(entry, '\\| ([A-Za-z]+)\\]', 1) AS author, tag
FROM (
  SELECT *, split_part(customer_notes, chr(10) || chr(10), pos + 1) AS entry
  FROM profiles CROSS JOIN (VALUES (0), (1)) AS v(pos)) e
CROSS JOIN (VALUES ('class.name'), ('class.email_address'), ('class.phone_number'),
                   ('class.location')) AS t(tag)
WHERE contains(substr(entry, strpos(entry, '] ') + 2),
  nullif(CASE tag WHEN 'class.name' THEN full_name WHEN 'class.email_address' THEN email
              WHEN 'class.phone_number' THEN telephone_number ELSE home_postcode END, ''))"""
    ),
    "freshness_status": of_summary(
        "SELECT *, CASE WHEN TIMESTAMP '2024-01-30 12:00:00' - newest <= "
        "CASE sla WHEN '30m' THEN INTERVAL 30 MINUTE WHEN '1h' THEN INTERVAL 1 HOUR "
        "ELSE INTERVAL 1 DAY END THEN 'fresh' ELSE 'stale' END AS status FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, '{sla}' AS sla, max(_updated_at) AS newest FROM {source}"
            for name, sla, source in (
                ("line_status", "30m", "status"),
                ("customer_profiles", "1d", "profiles"),
                ("customer_journeys", "1d", "journeys"),
                ("disruption_summary", "1h", "summary"),
                ("notification_targets", "1d", "journeys"),
            )
        )
        + ") f"
    ),
    "retention_purge": of_bronze(
        """SELECT row_id, line_id, _inserted_at, _delete_at FROM bronze
WHERE _delete_at > TIMESTAMP '2026-01-15 00:00:00'"""
    ),
    "retention_by_purpose": of_journeys(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS table_name, '{purpose}' AS purpose,
  CAST(_inserted_at AS DATE) AS inserted_on, count(*) AS rows, CAST({days} AS INTEGER) AS days,
  CAST(_inserted_at AS DATE) + {days} AS ends_on
FROM {source} GROUP BY CAST(_inserted_at AS DATE)"""
            for name, purpose, days, source in (
                ("line_status", "operational", 730, "status"),
                ("customer_profiles", "profile", 730, "profiles"),
                ("customer_journeys", "alerting", 365, "journeys"),
            )
        )
    ),
    "profile_metrics": of_journeys(JOURNEY_PROFILE),
    "profile_metrics_summary": of_summary(
        "\nUNION ALL\n".join(
            profiled("summary", "disruption_date", c, c.startswith("affected"))
            for c in (
                "line_id", "line_name", "disruption_date", "status_severity_description",
                "affected_customers", "affected_stations", "disruption_description", "last_updated",
                "_inserted_at", "_updated_at", "_delete_at",
            )
        )
    ),
    "drift_metrics": of_journeys(
        f"""SELECT * FROM (
  SELECT column_name, window_start,
    lag(window_start) OVER w AS previous_window,
    rows - lag(rows) OVER w AS rows_change,
    nulls / CAST(rows AS DOUBLE) - lag(nulls / CAST(rows AS DOUBLE)) OVER w AS null_share_change,
    distinct_values - lag(distinct_values) OVER w AS distinct_change,
    mean_value - lag(mean_value) OVER w AS mean_change
  FROM ({JOURNEY_PROFILE}) p
  WINDOW w AS (PARTITION BY column_name ORDER BY window_start)) d
WHERE previous_window IS NOT NULL"""
    ),
    "profile_sketches": of_journeys(WEEKLY_SKETCHES),
    "summary_by_changes": of_summary("SELECT * FROM summary"),
    "drift_distribution": of_journeys(
        """, numbers AS (
  SELECT date_trunc('day', _updated_at) AS w, unnest(['status_severity', 'age']) AS column_name,
    unnest([CAST(status_severity AS DOUBLE), CAST(age AS DOUBLE)]) AS x FROM journeys
), known AS (SELECT * FROM numbers WHERE x IS NOT NULL AND w IS NOT NULL),
ranges AS (
  SELECT *, lag(w) OVER o AS v FROM (
    SELECT column_name, w, min(x) AS lo, max(x) AS hi FROM known GROUP BY ALL) r
  WINDOW o AS (PARTITION BY column_name ORDER BY w)
), steps AS (
  SELECT a.column_name, a.w, a.v, b.lo, b.hi FROM ranges a JOIN ranges b ON a.column_name = b.column_name AND a.v = b.w
), placed AS (
  SELECT s.column_name, s.w, s.v, k.w = s.w AS is_now,
    CASE WHEN x < lo THEN 0 WHEN x > hi THEN 11 WHEN hi > lo THEN least(9, floor((x - lo) / (hi - lo) * 10)) + 1 ELSE 1 END AS bin
  FROM steps s JOIN known k ON k.column_name = s.column_name AND k.w IN (s.w, s.v)
), grid AS (
  SELECT g.*, count(p.bin) FILTER (p.is_now) AS n, count(p.bin) FILTER (NOT p.is_now) AS b
  FROM (SELECT s.column_name, s.w, s.v, unnest(range(12)) AS bin FROM steps s) g
  LEFT JOIN placed p ON p.column_name = g.column_name AND p.w = g.w AND p.bin = g.bin
  GROUP BY ALL
), shares AS (
  SELECT *, (n + 0.5) / (sum(n) OVER k + 6) AS p, (b + 0.5) / (sum(b) OVER k + 6) AS q,
    sum(n) OVER u / CAST(sum(n) OVER k AS DOUBLE) - sum(b) OVER u / CAST(sum(b) OVER k AS DOUBLE) AS apart
  FROM grid
  WINDOW k AS (PARTITION BY column_name, w), u AS (PARTITION BY column_name, w ORDER BY bin)
), categories AS (
  SELECT date_trunc('day', _updated_at) AS w, unnest(['line_id', 'status_severity_description', 'home_station']) AS column_name,
    unnest([line_id, status_severity_description, home_station]) AS x FROM journeys
), counted AS (SELECT column_name, w, x, count(*) AS n FROM categories WHERE x IS NOT NULL AND w IS NOT NULL GROUP BY ALL),
totals AS (
  SELECT *, lag(w) OVER o AS v, lag(total) OVER o AS before FROM (
    SELECT column_name, w, sum(n) AS total FROM counted GROUP BY ALL) t
  WINDOW o AS (PARTITION BY column_name ORDER BY w)
), category_pairs AS (
  SELECT t.column_name, t.w, t.v, x,
    coalesce(sum(c.n) FILTER (c.w = t.w), 0) / CAST(t.total AS DOUBLE) AS p,
    coalesce(sum(c.n) FILTER (c.w = t.v), 0) / CAST(t.before AS DOUBLE) AS q
  FROM totals t JOIN counted c ON c.column_name = t.column_name AND c.w IN (t.w, t.v)
  WHERE t.v IS NOT NULL GROUP BY t.column_name, t.w, t.v, x, t.total, t.before
)
SELECT column_name, w AS window_start, v AS previous_window, round(sum((p - q) * ln(p / q)), 6) AS stability_index,
  round(max(abs(apart)), 6) AS ks_distance, CAST(NULL AS DOUBLE) AS js_divergence
FROM shares GROUP BY column_name, w, v
UNION ALL
SELECT column_name, w, v, NULL, NULL,
  round(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
           + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 6)
FROM category_pairs GROUP BY column_name, w, v"""
    ),
}
