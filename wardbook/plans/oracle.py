"""SQL twins of the registered queries, over the test tables.

They restate fixture and models as one chain of common table expressions, without
looking at the DataFrame code; only parameters and test declarations are shared.
"""

from __future__ import annotations

from wardbook.functions.text import BLANKS
from wardbook.plans import model_tests
from wardbook.plans.registry import (
    ACCEPTED_STATUS,
    DAY_RANGE,
    EVENT_RANGE,
    TARGET_DATE,
    WINDOW_DAYS,
    TOLERANCES,
    TOP_TYPES,
    UNIQUE_COLUMNS,
)
from wardbook.schema import (
    CASE_KEPT_COLUMNS,
    RAW_COLUMNS,
    TIMESTAMP_COLUMNS,
    UPPER_COLUMNS,
)

WS = f"'{BLANKS}'"


def _record(overrides: dict[str, str] | None = None) -> str:
    """to_json of a raw row without raw_json, times in ISO form."""
    overrides = overrides or {}
    fields = []
    for c in RAW_COLUMNS:
        if c == "raw_json":
            continue
        value = overrides.get(c, c)
        if c in TIMESTAMP_COLUMNS:
            value = f"replace(CAST({value} AS VARCHAR), ' ', 'T')"
        fields.append(f"{c} := {value}")
    return f"CAST(to_json(struct_pack({', '.join(fields)})) AS VARCHAR)"


# Materialised, since DuckDB else stops with an internal error of its own ("dictionary
# column changed identity") where orders' columns meet computed join keys.
RAW = f"""
keyed AS MATERIALIZED (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus AS st, o_orderdate,
    o_orderkey % (SELECT count(*) FROM supplier) AS its_supplier,
    o_orderkey % (SELECT count(*) FROM part) AS its_part
  FROM orders
),
base AS (
  SELECT k, st, o_orderdate + to_seconds((k * 7919) % 86400) AS created,
         s_name, p_name, p_brand, p_type, n_nationkey AS nk, n_name, r_name
  FROM keyed
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON s_suppkey = its_supplier
  JOIN part ON p_partkey = its_part
),
dated AS (
  SELECT *, CASE WHEN st = 'F' OR k % 20 = 0 THEN created + to_seconds((k * 104729) % 2592000)
                 WHEN st = 'P' AND k % 10 = 1 THEN created - to_seconds(3600 * (1 + k % 24))
            END AS closed
  FROM base
),
raw_fields AS (
  SELECT CAST(k AS VARCHAR) AS unique_key, created AS created_date, closed AS closed_date,
    CASE WHEN k % 7 <> 0 THEN coalesce(closed, created + to_seconds(86400)) END
      AS resolution_action_updated_date,
    CASE WHEN k % 89 <> 0 THEN upper(substr(s_name, 1, 3)) || (k % 10) END AS agency,
    CASE WHEN k % 89 = 0 THEN '  ' ELSE '  ' || s_name || ' ' END AS agency_name,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 2 = 0 THEN lower(p_type) ELSE ' ' || p_type END
      AS complaint_type,
    p_brand AS descriptor,
    CASE WHEN k % 3 = 0 THEN '' ELSE p_name END AS descriptor_2,
    CASE WHEN k % 97 = 0 THEN '' WHEN st = 'F' THEN ' Closed ' WHEN st = 'O' THEN 'open'
         ELSE 'In Progress' END AS status,
    CASE WHEN k % 5 = 0 THEN '  ' ELSE 'text ' || k || ' ' END AS resolution_description,
    CASE k % 4 WHEN 0 THEN 'phone' WHEN 1 THEN 'ONLINE ' WHEN 2 THEN ' mobile' END
      AS open_data_channel_type,
    (k % 300) || ' main st' AS incident_address, ' Main St' AS street_name,
    CASE WHEN k % 2 = 0 THEN 'First Ave' END AS cross_street_1,
    CASE WHEN k % 3 = 0 THEN ' ' ELSE 'second ave' END AS cross_street_2,
    CAST(NULL AS VARCHAR) AS intersection_street_1,
    CAST(NULL AS VARCHAR) AS intersection_street_2,
    CASE WHEN k % 11 = 0 THEN ' Old Mill ' END AS landmark,
    n_name AS city,
    CASE WHEN k % 50 = 0 THEN ' ' WHEN k % 53 = 0 THEN NULL
         WHEN r_name = 'AFRICA' THEN 'Bronx' WHEN r_name = 'AMERICA' THEN 'Brooklyn '
         WHEN r_name = 'ASIA' THEN 'MANHATTAN' WHEN r_name = 'EUROPE' THEN 'queens'
         ELSE ' Staten Island' END AS borough,
    CAST(10000 + nk AS VARCHAR) AS incident_zip,
    (k % 18) || ' ' || lower(r_name) AS community_board,
    CAST(k % 51 AS VARCHAR) AS council_district,
    'Precinct ' || (k % 77) AS police_precinct,
    upper(r_name) AS park_borough, 'Unspecified' AS park_facility_name,
    CAST(NULL AS VARCHAR) AS taxi_pick_up_location,
    CAST(1000000000 + k AS VARCHAR) AS bbl,
    CAST(900000 + nk AS VARCHAR) AS x_coordinate_state_plane,
    ' ' || (100000 + nk) AS y_coordinate_state_plane,
    CASE WHEN k % 33 = 0 THEN 'bad' ELSE '40.' || (700 + nk) END AS latitude,
    CASE WHEN k % 37 <> 0 THEN '-73.' || (900 + nk) END AS longitude
  FROM dated
),
raw_located AS (
  SELECT *, CAST(to_json(struct_pack(latitude := latitude, longitude := longitude)) AS VARCHAR)
    AS location
  FROM raw_fields
),
raw AS (SELECT *, {_record()} AS raw_json FROM raw_located)"""

# Events as request records, before any JSON.
EVENT_ROWS = """
event_rows AS (
  SELECT event_id, user_id, event_id // 1000 AS page_no, event_id % 1000 AS pos,
    ts AS created_date,
    CASE event_type WHEN 'purchase' THEN ts + to_seconds(5400)
                    WHEN 'error' THEN ts - to_seconds(60) END AS closed_date,
    CAST(NULL AS TIMESTAMP) AS resolution_action_updated_date,
    event_type AS agency, 'Desk ' || event_type AS agency_name,
    event_type || ' request' AS complaint_type, props AS descriptor,
    CASE event_type WHEN 'purchase' THEN 'Closed' ELSE 'Open' END AS status,
    'online' AS open_data_channel_type,
    CASE event_type WHEN 'view' THEN 'Queens' WHEN 'click' THEN 'Bronx' END AS borough,
    CAST(10000 + user_id % 100 AS VARCHAR) AS incident_zip,
    '40.5' AS latitude, '-73.25' AS longitude,
    value
  FROM events
)"""


def _clean(column: str) -> str:
    if column == "borough":
        return f"coalesce(nullif(trim(upper(borough), {WS}), ''), 'UNSPECIFIED')"
    if column in UPPER_COLUMNS:
        return f"nullif(trim(upper({column}), {WS}), '')"
    if column in CASE_KEPT_COLUMNS:
        return f"nullif(trim({column}, {WS}), '')"
    if column in ("latitude", "longitude"):
        return f"TRY_CAST({column} AS DECIMAL(38,9))"
    return column


def _decimal_text(column: str) -> str:
    return f"regexp_replace(CAST({column} AS VARCHAR), '[.]?0+$', '')"


def _hash(parts: list[str], null_text: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce({p}, '{null_text}')" for p in parts) + ")"


# Fixed values.
LOCATION_PARTS = [
    "city",
    "borough",
    "landmark",
    "street_name",
    "incident_zip",
    "park_borough",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "incident_address",
    "park_facility_name",
    "latitude",
    "longitude",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
    "community_board",
    "council_district",
]


def _staging(source: str, columns: list[str]) -> str:
    cleaned = ", ".join(f"{_clean(c)} AS {c}" for c in columns)
    location = [_decimal_text(c) if c in ("latitude", "longitude") else c for c in LOCATION_PARTS]
    return f"""
cleaned AS (SELECT {cleaned} FROM {source}),
stg AS (
  SELECT *, {_hash(location, '')} AS location_key,
    {_hash(['agency', 'agency_name'], '<NULL>')} AS agency_key,
    {_hash(['complaint_type', 'descriptor', 'descriptor_2'], '<NULL>')} AS complaint_type_key,
    {_hash(['status'], '<NULL>')} AS status_key,
    {_hash(['open_data_channel_type'], '<NULL>')} AS channel_key,
    CAST(created_date AS DATE) AS created_day, CAST(closed_date AS DATE) AS closed_day,
    closed_date IS NOT NULL AND created_date IS NOT NULL AND closed_date < created_date
      AS invalid_close_before_create,
    latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -90 AND 90
      AND longitude BETWEEN -180 AND 180 AS valid_lat_long
  FROM cleaned
)"""


def _calendar(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS BIGINT) AS date_id, {d} AS full_date,
    CAST(day({d}) AS BIGINT) AS day_of_month, CAST(month({d}) AS BIGINT) AS month,
    monthname({d}) AS month_name, CAST(quarter({d}) AS BIGINT) AS quarter,
    CAST(year({d}) AS BIGINT) AS year, CAST(isodow({d}) AS BIGINT) AS day_of_week,
    dayname({d}) AS day_name, isodow({d}) IN (6, 7) AS is_weekend"""


def _date_id(column: str) -> str:
    return f"CAST(strftime(CAST({column} AS DATE), '%Y%m%d') AS BIGINT)"


DATES = "unnest([created_date, closed_date, resolution_action_updated_date])"
# Fixed values.
CRITICAL = [
    "location_id",
    "complaint_type_id",
    "agency_id",
    "status_id",
]
INVALID = "coalesce(closed_at < created_at, false)"
MISMATCH = "coalesce(closed_at >= created_at AND status <> 'CLOSED', false)"


def _dimension(key: str, key_name: str, *columns: str) -> str:
    # Hashes of NULL attributes keep their key in the facts; dimensions skip them.
    names = ", ".join(columns)
    return (
        f"SELECT {key} AS {key_name}, {names} FROM stg"
        f" WHERE coalesce({names}, NULL) IS NOT NULL GROUP BY ALL"
    )


CORE = f"""
dim_date AS (
  SELECT {_calendar('d')}
  FROM (SELECT DISTINCT CAST(t AS DATE) AS d FROM (SELECT {DATES} AS t FROM stg) WHERE t IS NOT NULL)
),
dim_location AS (
  SELECT location_key AS location_id, location_key, {', '.join(LOCATION_PARTS)}
  FROM stg GROUP BY ALL
),
dim_agency AS ({_dimension('agency_key', 'agency_id', 'agency', 'agency_name')}),
dim_complaint_type AS (
  {_dimension('complaint_type_key', 'complaint_type_id', 'complaint_type', 'descriptor',
              'descriptor_2')}
),
dim_status AS ({_dimension('status_key', 'status_id', 'status')}),
dim_channel AS ({_dimension('channel_key', 'channel_id', 'open_data_channel_type')}),
fct_complaint AS (
  SELECT unique_key AS complaint_key, unique_key, created_date AS created_at,
    closed_date AS closed_at, resolution_action_updated_date AS resolution_action_updated_at,
    {_date_id('created_date')} AS created_date_id, {_date_id('closed_date')} AS closed_date_id,
    {_date_id('resolution_action_updated_date')} AS resolution_action_date_id,
    location_key AS location_id, agency_key AS agency_id,
    complaint_type_key AS complaint_type_id, status_key AS status_id,
    channel_key AS channel_id, police_precinct
  FROM stg WHERE unique_key IS NOT NULL
),
fct_complaint_text AS (
  SELECT unique_key, resolution_description FROM stg WHERE unique_key IS NOT NULL
),
flagged AS (
  SELECT complaint_key, unique_key, created_at, closed_at,
    CAST(created_at AS DATE) AS metric_date,
    CAST(date_trunc('month', created_at) AS DATE) AS metric_month,
    location_id, complaint_type_id, agency_id, status_id,
    date_sub('second', created_at, closed_at) / CAST(3600 AS DOUBLE) AS resolution_hours,
    CAST({INVALID} AS INTEGER) AS is_invalid_time_order,
    {', '.join(f'CAST({c} IS NULL AS INTEGER) AS is_missing_{c}' for c in CRITICAL)},
    CAST({' OR '.join(f'{c} IS NULL' for c in CRITICAL)} AS INTEGER) AS is_missing_critical_fields,
    CAST({MISMATCH} AS INTEGER) AS is_closed_at_status_mismatch
  FROM fct_complaint LEFT JOIN dim_status USING (status_id)
)"""

# Fixed values.
FLAG_NAMES = [
    "invalid_time_order",
    "missing_critical_fields",
    "missing_location_id",
    "missing_complaint_type_id",
    "missing_agency_id",
    "missing_status_id",
    "closed_at_status_mismatch",
]
VALID = "closed_at IS NOT NULL AND created_at IS NOT NULL AND is_invalid_time_order = 0"
SECONDS = "date_sub('second', created_at, closed_at)"


def _mean(where: str) -> str:
    return (
        f"CAST(sum({SECONDS}) FILTER (WHERE {where}) AS DOUBLE)"
        f" / count(*) FILTER (WHERE {where}) / CAST(3600 AS DOUBLE)"
    )


def _quantile(q: float, where: str) -> str:
    return f"quantile_disc(resolution_hours, {q}) FILTER (WHERE {where})"


# Fixed values.
QUANTILE_NAMES = {"median": 0.5, "p90": 0.9, "p95": 0.95}
FLAG_COUNTS = ", ".join(
    f"CAST(sum(is_{f}) AS BIGINT) AS {f}_count" for f in FLAG_NAMES
)
# Fixed values.
PARTS_OF_DAY = {
    "morning": "6 AND 11",
    "afternoon": "12 AND 17",
    "evening": "18 AND 23",
    "overnight": "0 AND 5",
}

MARTS = f"""
created_days AS (
  SELECT CAST(created_at AS DATE) AS metric_date, count(*) AS created_count,
    {', '.join(f"count(*) FILTER (WHERE hour(created_at) BETWEEN {h}) AS created_{p}_count"
               for p, h in PARTS_OF_DAY.items())},
    {FLAG_COUNTS}
  FROM flagged WHERE created_at IS NOT NULL GROUP BY 1
),
closed_days AS (
  SELECT CAST(closed_at AS DATE) AS metric_date, count(*) AS closed_count,
    {_mean('true')} AS avg_resolution_hours,
    {', '.join(f"{_quantile(q, 'true')} AS {n}_resolution_hours"
               for n, q in QUANTILE_NAMES.items())}
  FROM flagged WHERE {VALID} GROUP BY 1
),
daily AS (
  SELECT c.metric_date, created_count, coalesce(closed_count, 0) AS closed_count,
    created_count - coalesce(closed_count, 0) AS daily_net_case_flow, avg_resolution_hours,
    median_resolution_hours, p90_resolution_hours, p95_resolution_hours,
    {', '.join(f'created_{p}_count' for p in PARTS_OF_DAY)},
    {', '.join(f'{f}_count' for f in FLAG_NAMES)}
  FROM created_days c LEFT JOIN closed_days d ON c.metric_date = d.metric_date
),
monthly AS (
  SELECT metric_month AS month_start, count(*) AS created_count,
    count(*) FILTER (WHERE {VALID}) AS closed_count,
    count(*) - count(*) FILTER (WHERE {VALID}) AS net_case_flow,
    round({_mean(VALID)}, 2) AS avg_resolution_hours,
    {', '.join(f"round({_quantile(q, VALID)}, 2) AS {n}_resolution_hours"
               for n, q in QUANTILE_NAMES.items())},
    {FLAG_COUNTS}
  FROM flagged WHERE metric_month IS NOT NULL GROUP BY 1
),
named AS (
  SELECT created_at, coalesce(borough, 'UNSPECIFIED') AS borough,
    coalesce(complaint_type, 'UNSPECIFIED') AS complaint_type
  FROM flagged LEFT JOIN dim_location USING (location_id)
  LEFT JOIN dim_complaint_type USING (complaint_type_id)
  WHERE created_at IS NOT NULL
),
mix_counts AS (
  SELECT CAST(min(created_at) AS DATE) AS min_created_date,
    CAST(max(created_at) AS DATE) AS max_created_date, borough, complaint_type,
    count(*) AS total_requests
  FROM named GROUP BY borough, complaint_type
),
mix_shares AS (
  SELECT *, sum(total_requests) OVER (PARTITION BY borough) AS b, sum(total_requests) OVER () AS a
  FROM mix_counts
),
mix AS (
  SELECT min_created_date, max_created_date, borough, complaint_type, total_requests,
    CAST(round(CAST(100 * total_requests AS DOUBLE) / b, 2) AS DOUBLE) AS pct_of_borough_requests,
    CAST(round(CAST(100 * total_requests AS DOUBLE) / a, 2) AS DOUBLE) AS pct_of_all_requests
  FROM mix_shares
)"""

# Models under the names the tests are declared with.
SQL_NAMES = {
    "stg_311_requests": "stg",
    "dim_date": "dim_date",
    "dim_location": "dim_location",
    "dim_agency": "dim_agency",
    "dim_complaint_type": "dim_complaint_type",
    "dim_status": "dim_status",
    "dim_channel": "dim_channel",
    "fct_311_complaint": "fct_complaint",
    "fct_311_complaint_text": "fct_complaint_text",
    "int_complaints_flagged": "flagged",
    "fct_daily_metrics": "daily",
    "fct_monthly_metrics": "monthly",
    "fct_borough_complaint_mix": "mix",
}

STG = _staging("raw", RAW_COLUMNS)
DOUBLE_COORDINATES = (
    "* REPLACE (CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude)"
)


def _with(*chain: str, select: str) -> str:
    return f"WITH {','.join(chain)}\n{select}"


def _raw(select: str) -> str:
    return _with(RAW, select=select)


def _stg(select: str) -> str:
    return _with(RAW, STG, select=select)


def _core(select: str) -> str:
    return _with(RAW, STG, CORE, select=select)


def _marts(select: str) -> str:
    return _with(RAW, STG, CORE, MARTS, select=select)


ORDER_VERSIONS = """
versions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS unique_key,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS created_date,
    o_orderpriority AS agency, o_orderstatus AS status, o_orderkey % 8 AS page_no,
    o_orderkey AS pos
  FROM orders
)"""


def _latest(source: str, columns: str, order: str, key: str = "unique_key") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order})"
        f" AS rn FROM {source}) WHERE rn = 1"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _in_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _duplicates(table: str, column: str) -> str:
    return (
        f"SELECT {column} AS unique_field, count(*) AS n_records FROM {table}"
        f" WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    )


def _unaccepted(column: str, accepted: list[str]) -> str:
    return (
        f"SELECT {column} AS value_field, count(*) AS n_records FROM stg"
        f" WHERE {column} NOT IN {_in_list(accepted)} GROUP BY 1"
    )


def _orphan_rows(child: str, column: str, parent: str, field: str) -> str:
    return (
        f"SELECT c.{column} AS from_field FROM {SQL_NAMES[child]} c"
        f" LEFT JOIN {SQL_NAMES[parent]} p ON c.{column} = p.{field}"
        f" WHERE c.{column} IS NOT NULL AND p.{field} IS NULL"
    )


def _wrong_flags(flag: str) -> str:
    return (
        f"SELECT unique_key, created_at, closed_at, CAST({flag} AS INTEGER) AS is_invalid_time_order"
        f" FROM flagged WHERE {flag} <> CAST({INVALID} AS INTEGER)"
    )


def _share_total(tolerance: str) -> str:
    return (
        "SELECT round(sum(pct_of_all_requests), 2) AS pct_sum FROM mix"
        f" HAVING abs(round(sum(pct_of_all_requests), 2) - 100) > {tolerance}"
    )


def _report() -> str:
    def counted(test: str, rows: str) -> str:
        return f"SELECT '{test}' AS test, count(*) AS failures FROM ({rows})"

    parts = [
        counted(f"not_null {m}.{c}", f"SELECT 1 FROM {SQL_NAMES[m]} WHERE {c} IS NULL")
        for m, columns in model_tests.NOT_NULL.items()
        for c in columns
    ]
    parts += [
        counted(f"unique {m}.{c}", _duplicates(SQL_NAMES[m], c))
        for m, columns in model_tests.UNIQUE.items()
        for c in columns
    ]
    for m, columns in model_tests.COMPOSITE_UNIQUE.items():
        names = ", ".join(columns)
        rows = f"SELECT 1 FROM {SQL_NAMES[m]} GROUP BY {names} HAVING count(*) > 1"
        parts.append(counted(f"unique_composite_key {m}", rows))
    parts.append(
        counted(
            "accepted_values stg_311_requests.borough",
            _unaccepted("borough", model_tests.ACCEPTED_BOROUGHS),
        )
    )
    for child, column, parent, field in model_tests.RELATIONSHIPS:
        parts.append(
            counted(
                f"relationships {child}.{column} {parent}.{field}",
                _orphan_rows(child, column, parent, field),
            )
        )
    parts.append(counted("shares_total_100 fct_borough_complaint_mix", _share_total("1.00")))
    parts.append(
        counted("time_order_flag int_complaints_flagged", _wrong_flags("is_invalid_time_order"))
    )
    return f"SELECT *, failures = 0 AS passed FROM ({_union(parts)})"


def _page_rows() -> str:
    """Both versions of each request: page k holds the first at 0 and the final one at 1."""
    return """
page_rows AS (
  SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS closed_date, 'New' AS status),
    CAST(unique_key AS BIGINT) AS page_no, CAST(0 AS BIGINT) AS pos FROM raw
  UNION ALL
  SELECT *, CAST(unique_key AS BIGINT) AS page_no, CAST(1 AS BIGINT) AS pos FROM raw
)"""


def _event_raw() -> str:
    """Event rows as raw request rows, fields the records lack as NULL."""
    known = [
        "created_date",
        "closed_date",
        "resolution_action_updated_date",
        "agency",
        "agency_name",
        "complaint_type",
        "descriptor",
        "status",
        "open_data_channel_type",
        "borough",
        "incident_zip",
        "latitude",
        "longitude",
    ]
    columns = []
    for c in RAW_COLUMNS:
        if c == "unique_key":
            columns.append("CAST(event_id AS VARCHAR) AS unique_key")
        else:
            columns.append(c if c in known else f"CAST(NULL AS VARCHAR) AS {c}")
    first, last = EVENT_RANGE
    return f"""
event_raw AS (
  SELECT {', '.join(columns)} FROM event_rows
  WHERE created_date BETWEEN TIMESTAMP '{first} 00:00:00' AND TIMESTAMP '{last} 23:59:59'
)"""


def statements() -> dict[str, str]:
    first, last = DAY_RANGE
    target, offset = TARGET_DATE
    text_columns = [c for c in RAW_COLUMNS if c in {*UPPER_COLUMNS, *CASE_KEPT_COLUMNS, "borough"}]
    versions = ORDER_VERSIONS
    in_page_order = "page_no DESC, created_date DESC NULLS LAST, pos DESC"
    return {
        "raw_pages": _with(
            RAW, _page_rows(), select="SELECT page_no, pos, unique_key, status FROM page_rows"
        ),
        "raw_normalized": _with(
            RAW,
            _page_rows(),
            select="SELECT * EXCLUDE (raw_json), complaint_type AS json_complaint_type"
            " FROM page_rows",
        ),
        "raw_page_cap": _with(
            EVENT_ROWS,
            select="SELECT page_no, pos, event_id AS unique_key FROM event_rows WHERE page_no < 3",
        ),
        "raw_dedup_latest": _with(
            versions,
            select=_latest(
                "versions", "* EXCLUDE (rn)", "created_date DESC NULLS LAST, pos DESC"
            ),
        ),
        "raw_upsert": _with(
            versions,
            """
merged AS (
  SELECT * FROM versions
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, 'stored', -1, 0 FROM customer
)""",
            select=_latest("merged", "unique_key, created_date, agency, status", in_page_order),
        ),
        "raw_upsert_table": """
WITH changed AS (
  SELECT o_orderkey AS k, o_orderdate AS t, o_orderstatus AS s,
    date_trunc('month', o_orderdate) = DATE '1996-01-01' AS january FROM orders
), after AS (
  SELECT k, (k % 3 = 0 OR k % 5 = 0 OR k % 101 = 0 OR january) AS second, t, s, january FROM changed
), stored AS (
  SELECT CAST(k AS VARCHAR) AS unique_key,
    CASE WHEN second AND k % 101 = 0 THEN NULL WHEN january THEN t + INTERVAL 1 MONTH
         WHEN k % 5 = 0 THEN t + INTERVAL 40 DAY ELSE t END AS created_date,
    CASE WHEN second THEN 'run 2' WHEN k % 7 = 0 THEN 'page 1' ELSE s END AS status
  FROM after
)
SELECT *, CAST(created_date AS DATE) AS created_day FROM stored""",
        "raw_probe_reset": """
SELECT 'before' AS status, count(*) AS row_count, 'raw_311_requests' AS table_name FROM orders
UNION ALL
SELECT 'after', count(*), 'raw_311_requests_probe' FROM orders""",
        "raw_gate": _raw(
            "SELECT CAST(35 AS BIGINT) AS field_count, count(*) AS row_count FROM raw"
        ),
        "raw_target_date": _raw(
            f"SELECT unique_key, created_date FROM raw WHERE created_date >= DATE '{target}'"
            f" AND created_date < DATE '{target}' + {offset}"
        ),
        "raw_date_range": _raw(
            "SELECT unique_key, created_date FROM raw WHERE created_date"
            f" BETWEEN TIMESTAMP '{first} 00:00:00' AND TIMESTAMP '{last} 23:59:59'"
        ),
        "rows_per_day": _raw(
            "SELECT CAST(created_date AS DATE) AS day, count(*) AS row_count FROM raw"
            f" WHERE CAST(created_date AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"
            " GROUP BY 1 ORDER BY 1"
        ),
        "stream_ingest": _with(
            EVENT_ROWS,
            select=_latest(
                "event_rows",
                "CAST(user_id AS VARCHAR) AS unique_key, created_date, closed_date, agency,"
                " descriptor, CAST(to_json(struct_pack(reading := value)) AS VARCHAR) AS location,"
                " CAST(created_date AS DATE) AS created_day",
                in_page_order,
                key="user_id",
            ),
        ),
        "raw_window": _with(
            EVENT_ROWS,
            "current_rows AS ("
            + _latest(
                "event_rows",
                "CAST(user_id AS VARCHAR) AS unique_key, created_date, agency,"
                " CAST(created_date AS DATE) AS created_day",
                in_page_order,
                key="user_id",
            )
            + ")",
            select="SELECT *, 'raw_311_requests' AS table_name FROM current_rows UNION ALL"
            " SELECT *, 'raw_311_requests_probe' FROM current_rows"
            f" WHERE created_day BETWEEN DATE '{WINDOW_DAYS[0]}' AND DATE '{WINDOW_DAYS[1]}'",
        ),
        "backfill_daily": _with(
            EVENT_ROWS,
            _event_raw(),
            _staging("event_raw", RAW_COLUMNS),
            CORE,
            MARTS,
            select="SELECT * FROM daily",
        ),
        "refreshed_daily": _with(
            EVENT_ROWS,
            _event_raw(),
            _staging("event_raw", RAW_COLUMNS),
            CORE,
            MARTS,
            select="SELECT * FROM daily",
        ),
        "refreshed_mix": _with(
            EVENT_ROWS,
            _event_raw(),
            _staging("event_raw", RAW_COLUMNS),
            CORE,
            MARTS,
            select="SELECT * FROM mix",
        ),
        "stg_requests": _with(
            RAW, _staging("raw", RAW_COLUMNS), select=f"SELECT {DOUBLE_COORDINATES} FROM stg"
        ),
        "stg_clean_text": _stg(f"SELECT unique_key, {', '.join(text_columns)} FROM stg"),
        "stg_numeric": _stg(
            "SELECT unique_key, CAST(latitude AS DOUBLE) AS latitude,"
            " CAST(longitude AS DOUBLE) AS longitude,"
            f" {_decimal_text('stg.latitude')} AS latitude_text,"
            f" {_decimal_text('stg.longitude')} AS longitude_text FROM stg"
        ),
        "stg_validity": _stg(
            "SELECT unique_key, invalid_close_before_create, valid_lat_long FROM stg"
        ),
        "surrogate_keys": _stg(
            "SELECT unique_key, location_key, agency_key, complaint_type_key, status_key,"
            " channel_key FROM stg"
        ),
        "date_parts": _raw(f"SELECT unique_key, {_calendar('CAST(created_date AS DATE)')} FROM raw"),
        "dim_date": _core("SELECT * FROM dim_date"),
        "dim_location": _core(f"SELECT {DOUBLE_COORDINATES} FROM dim_location"),
        "dim_agency": _core("SELECT * FROM dim_agency"),
        "dim_complaint_type": _core("SELECT * FROM dim_complaint_type"),
        "dim_status": _core("SELECT * FROM dim_status"),
        "dim_channel": _core("SELECT * FROM dim_channel"),
        "fct_complaint": _core("SELECT * FROM fct_complaint"),
        "fct_complaint_text": _core("SELECT * FROM fct_complaint_text"),
        "complaints_flagged": _core("SELECT * FROM flagged"),
        "daily_metrics": _marts("SELECT * FROM daily"),
        "monthly_metrics": _marts("SELECT * FROM monthly ORDER BY month_start"),
        "borough_mix": _marts("SELECT * FROM mix"),
        "resolution_percentiles": _core(
            "SELECT metric_month, count(*) AS closed_count,"
            f" {_mean('true')} AS avg_resolution_hours, "
            + ", ".join(
                f"{_quantile(q, 'true')} AS {n}_resolution_hours"
                for n, q in QUANTILE_NAMES.items()
            )
            + f" FROM flagged WHERE {VALID} GROUP BY 1"
        ),
        "created_vs_closed": _marts("SELECT metric_date, created_count, closed_count FROM daily"),
        "top_complaint_types": _marts(
            "SELECT complaint_type, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM mix"
            f" GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {TOP_TYPES}"
        ),
        "dq_not_null": _stg(
            _union(
                [
                    f"SELECT '{c}' AS column_name, count(*) AS failures FROM stg WHERE {c} IS NULL"
                    for c in [
                        *RAW_COLUMNS,
                        "location_key",
                        "agency_key",
                        "complaint_type_key",
                        "status_key",
                        "channel_key",
                        "created_day",
                        "closed_day",
                        "invalid_close_before_create",
                        "valid_lat_long",
                    ]
                ]
            )
        ),
        "dq_unique": _stg(
            _union(
                [
                    f"SELECT *, '{c}' AS column_name FROM ({_duplicates('stg', c)})"
                    for c in UNIQUE_COLUMNS
                ]
            )
        ),
        "dq_accepted_values": _stg(
            _union(
                [
                    f"SELECT *, '{c}' AS column_name FROM ({_unaccepted(c, values)})"
                    for c, values in {
                        "borough": model_tests.ACCEPTED_BOROUGHS,
                        "status": ACCEPTED_STATUS,
                    }.items()
                ]
            )
        ),
        "dq_relationships": _core(
            _union(
                [
                    "SELECT CAST(from_field AS VARCHAR) AS from_field, count(*) AS row_count,"
                    f" '{child}.{column}' AS reference"
                    f" FROM ({_orphan_rows(child, column, parent, field)}) GROUP BY 1"
                    for child, column, parent, field in model_tests.RELATIONSHIPS
                ]
            )
        ),
        "dq_composite_key": _stg(
            "SELECT agency, agency_name, count(*) AS row_count FROM stg GROUP BY 1, 2"
            " HAVING count(*) > 1"
        ),
        "dq_pct_sum": _marts(
            _union([f"SELECT *, '{t}' AS tolerance FROM ({_share_total(t)})" for t in TOLERANCES])
        ),
        "dq_time_order_flag": _core(
            _union(
                [
                    f"SELECT *, '{name}' AS flag FROM ({_wrong_flags(flag)})"
                    for name, flag in {"stored": "is_invalid_time_order", "cleared": "0"}.items()
                ]
            )
        ),
        "dq_report": _marts(_report()),
    }
