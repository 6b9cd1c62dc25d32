"""The registered queries as SQL over the given tables, for an independent engine.

Each text computes its result from the tables themselves, through shared WITH clauses that state
the derived fact, its map entries and the key numbering once.
"""

from __future__ import annotations

from checks import oracle_stores
from widefold.model import STANDARD_COLUMNS, flat_schema

INT_COLUMNS = 12
FLOAT_COLUMNS = 5
TENANT = 1
DIMS_METRIC = "f_1_view_success"
DIMS_FLOW = "view"
COUNT_METRIC = "event_count"
START = "2024-01-01 00:00:00"
END = "2024-01-31 00:00:00"
WINDOW_HOURS = 360
WINDOW_END = "2024-01-16 00:00:00"
SHORT_END = "2024-01-01 01:00:00"
CHUNK_MINUTES = 60

RAW = """raw AS (
  SELECT event_id, ts AS exact_ts, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props,
    CAST(user_id % 3 AS INTEGER) AS customer_id,
    CAST(user_id AS VARCHAR) AS client,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session,
    '1.' || CAST(event_id % 7 AS VARCHAR) AS app_version,
    CAST(event_id % 16 AS INTEGER) AS partition_id,
    list_extract(['web', 'ios', 'android', 'tv'], CAST(user_id % 4 AS INTEGER) + 1) AS platform,
    list_extract(['phone', 'tablet', 'console'], CAST(user_id % 3 AS INTEGER) + 1) AS device_category,
    list_extract(['us', 'de', 'in', 'br', 'jp'], CAST(user_id % 5 AS INTEGER) + 1) AS country_iso,
    user_id % 5 AS country
  FROM events)"""

_INT_ENTRIES = [
    (1, "'f_' || customer_id || '_' || event_type || '_success'", "CAST(value > 100 AS BIGINT)", "TRUE"),
    (
        2,
        "'f_' || customer_id || '_' || event_type || '_total_duration'",
        "CAST(round(value * 100) AS BIGINT)",
        "NOT (customer_id = 0 AND event_type = 'signup')",
    ),
    (4, "'retries'", "1", "event_type = 'click'"),
    (7, "' '", "5", "event_type = 'error'"),
    (9, "'retries'", "10", "event_type = 'purchase'"),
    (15, "'event_count'", "1", "TRUE"),
]

ENTRIES = "entries AS (\n" + "\n  UNION ALL ".join(
    [
        f"SELECT *, 'int' AS kind, {n} AS group_no, {key} AS key, CAST({value} AS BIGINT) AS ival,"
        f" CAST(NULL AS DOUBLE) AS dval FROM raw WHERE {condition}"
        for n, key, value, condition in _INT_ENTRIES
    ]
    + [
        "SELECT *, 'float' AS kind, 1 AS group_no, event_type || '_value' AS key, CAST(NULL AS BIGINT) AS ival,"
        " CAST(CAST(value AS FLOAT) AS DOUBLE) AS dval FROM raw"
    ]
) + ")"

MAPPING = """mapping AS (
  SELECT customer_id, kind, key, CAST(row_number() OVER (PARTITION BY customer_id, kind ORDER BY key) AS INTEGER) AS idx
  FROM (SELECT DISTINCT customer_id, kind, key FROM entries WHERE trim(key) <> ''))"""

TAGS = """tags AS (
  SELECT DISTINCT customer_id, key FROM (
    SELECT customer_id, 'k' AS key FROM raw UNION ALL SELECT customer_id, event_type FROM raw))"""

BASE = f"{RAW},\n{ENTRIES},\n{MAPPING}"

# Expressions of the standard columns in the derived fact; the rest are 0 or ''.
_GIVEN = {
    "watermarkMs": "ts",
    "appVersion": "app_version",
    "partitionId": "partition_id",
    "retentionDate": "CAST(ts AS DATE) + 30",
    "platform": "platform",
    "deviceCategory": "device_category",
    "countryIso": "country_iso",
    "country": "country",
}
_SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def groups(grain: str) -> str:
    """One row per group, with the columns of its earliest raw row."""
    return f"""groups AS (
  SELECT date_trunc('{grain}', ts) AS t, client, session, customer_id, min({{'at': ts, 'watermarkMs': ts,
      'platform': platform, 'appVersion': app_version, 'deviceCategory': device_category, 'country': country,
      'countryIso': country_iso, 'partitionId': partition_id, 'retentionDate': CAST(ts AS DATE) + 30}}) AS s
  FROM raw GROUP BY ALL)"""


def cells(grain: str, rule: str = "last") -> str:
    """One row per group and numbered key, conflicts between map columns resolved."""
    pick = {
        "last": "arg_max(isum, group_no) AS ival, arg_max(dsum, group_no) AS dval",
        "sum": "CAST(sum(isum) AS BIGINT) AS ival, sum(dsum) AS dval",
    }[rule]
    return f"""group_sums AS (
  SELECT date_trunc('{grain}', ts) AS t, client, session, customer_id, kind, key, group_no,
    CAST(sum(ival) AS BIGINT) AS isum, sum(dval) AS dsum
  FROM entries GROUP BY ALL),
cells AS (
  SELECT t, client, session, customer_id, kind, key, idx, {pick}
  FROM group_sums JOIN mapping USING (customer_id, kind, key)
  GROUP BY t, client, session, customer_id, kind, key, idx)"""


def flat(grain: str, rule: str = "last") -> str:
    """WITH clauses up to the flat table."""
    standard = {"timestampMs": "t", "clientId": "client", "sessionId": "session", "customerId": "customer_id"}
    fields = flat_schema(INT_COLUMNS, FLOAT_COLUMNS).fields
    columns = []
    for field in fields:
        name, kind = field.name, field.dataType.simpleString()
        if name in standard:
            columns.append(f"groups.{standard[name]} AS {name}")
        elif name in _GIVEN:
            columns.append(f"CAST(any_value(groups.s.{name}) AS {_SQL_TYPES[kind]}) AS {name}")
        elif name in STANDARD_COLUMNS:
            default = "''" if kind == "string" else "0"
            columns.append(f"CAST({default} AS {_SQL_TYPES[kind]}) AS {name}")
        elif name.startswith("int"):
            columns.append(f"coalesce(max(CASE WHEN kind = 'int' AND idx = {name[3:]} THEN ival END), 0) AS {name}")
        else:
            value = f"coalesce(max(CASE WHEN kind = 'float' AND idx = {name[5:]} THEN dval END), 0)"
            columns.append(f"round(CAST(CAST({value} AS FLOAT) AS DOUBLE), 4) AS {name}")
    body = ",\n    ".join(columns)
    return f"""{BASE},
{groups(grain)},
{cells(grain, rule)},
flat AS (
  SELECT {body}
  FROM groups LEFT JOIN cells USING (t, client, session, customer_id)
  GROUP BY groups.t, groups.client, groups.session, groups.customer_id)"""


FLAT = flat("minute")

# Positional column of a metric, read from the flat table by its number.
CELL_VALUES = f"""{BASE},
{groups('minute')},
{cells('minute')},
metrics AS (
  SELECT cells.*, groups.s.deviceCategory AS "deviceCategory", groups.s.countryIso AS "countryIso",
    groups.s.platform AS platform, groups.s.country AS country
  FROM cells JOIN groups USING (t, client, session, customer_id) WHERE kind = 'int')"""

RAW_VALUES = f"""{BASE},
metrics AS (
  SELECT entries.*, date_trunc('minute', ts) AS t, device_category AS "deviceCategory", country_iso AS "countryIso"
  FROM entries WHERE kind = 'int')"""

SHAPES = {"dims": '"deviceCategory", "countryIso", platform', "country": "country", "minute": "t"}
OUTPUTS = {**SHAPES, "minute": "t AS minute"}
QUERY_TYPES = {"dims": "aggregation", "country": "groupby_country", "minute": "groupby_minute"}


def metric_sql(values: str, shape: str, key: str, end: str = END, extra: str = "AND ival > 0") -> str:
    time = "t" if values is CELL_VALUES else "ts"
    return f"""WITH {values}
SELECT {OUTPUTS[shape]}, CAST(sum(ival) AS BIGINT) AS metric_sum FROM metrics
WHERE customer_id = {TENANT} AND key = '{key}' {extra}
  AND {time} >= TIMESTAMP '{START}' AND {time} < TIMESTAMP '{end}'
GROUP BY {SHAPES[shape]}"""


UNFILTERED = f"""WITH {FLAT},
numbered AS (SELECT idx FROM mapping WHERE customer_id = {TENANT} AND kind = 'int' AND key = '{DIMS_METRIC}')
SELECT "deviceCategory", "countryIso", platform, CAST(sum(coalesce(ival, 0)) AS BIGINT) AS metric_sum
FROM (SELECT groups.s.deviceCategory AS "deviceCategory", groups.s.countryIso AS "countryIso",
        groups.s.platform AS platform, cells.ival
      FROM groups LEFT JOIN (SELECT * FROM cells JOIN numbered USING (idx) WHERE kind = 'int') AS cells
        USING (t, client, session, customer_id)
      WHERE customer_id = {TENANT})
GROUP BY ALL"""

FLOWS = """flows AS (
  SELECT customer_id, key AS metric_key, event_type AS flowid, count(DISTINCT event_id) AS cnt, min(group_no) AS group_no
  FROM entries WHERE kind = 'int' GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id, metric_key ORDER BY cnt DESC, flowid) AS flow_rank,
    count(*) OVER (PARTITION BY customer_id, metric_key) AS flow_count
  FROM flows),
located AS (
  SELECT ranked.customer_id, metric_key, flowid, 'metricIntGroup' || group_no AS source_map_column, group_no,
    'int' || idx AS target_physical_column, flow_count > 1 AS has_multiple_flowids
  FROM ranked JOIN mapping ON mapping.customer_id = ranked.customer_id AND mapping.kind = 'int' AND mapping.key = metric_key
  WHERE flow_rank = 1)"""


def flat_report_sql(shape: str) -> str:
    names = SHAPES[shape]
    return f"""SELECT customer_id, key AS metric_key, '{QUERY_TYPES[shape]}' AS query_type, {OUTPUTS[shape]},
    CAST(sum(ival) AS BIGINT) AS metric_sum
  FROM metrics WHERE ival > 0 GROUP BY customer_id, key, {names}"""


def map_report_sql(shape: str, all_flows: bool = False) -> str:
    flow = "TRUE" if all_flows else "entries.event_type = located.flowid"
    metric = f"AND located.metric_key = '{COUNT_METRIC}'" if all_flows else ""
    outputs = {
        "dims": 'device_category AS "deviceCategory", country_iso AS "countryIso", platform',
        "country": "country",
        "minute": "date_trunc('minute', ts) AS minute",
    }[shape]
    return f"""SELECT entries.customer_id, located.metric_key, '{QUERY_TYPES[shape]}' AS query_type, {outputs},
    CAST(sum(ival) AS BIGINT) AS metric_sum
  FROM entries JOIN located ON entries.customer_id = located.customer_id AND entries.key = located.metric_key
    AND entries.kind = 'int' AND entries.group_no = located.group_no AND {flow} {metric}
  WHERE ival > 0 GROUP BY ALL"""


VALIDATION = f"""{CELL_VALUES},
{FLOWS},
old_report AS ({map_report_sql('dims')}),
new_report AS ({flat_report_sql('dims')})"""

TOTALS = f"""{VALIDATION},
totals AS (
  SELECT customer_id, metric_key, query_type, coalesce(old_total_sum, 0) = coalesce(new_total_sum, 0) AS passed,
    coalesce(row_count_old, 0) AS row_count_old, coalesce(row_count_new, 0) AS row_count_new,
    coalesce(old_total_sum, 0) AS old_total_sum, coalesce(new_total_sum, 0) AS new_total_sum,
    abs(coalesce(old_total_sum, 0) - coalesce(new_total_sum, 0)) AS difference
  FROM (SELECT customer_id, metric_key, query_type, count(*) AS row_count_old, CAST(sum(metric_sum) AS BIGINT) AS old_total_sum
        FROM old_report GROUP BY ALL) AS o
  FULL JOIN (SELECT customer_id, metric_key, query_type, count(*) AS row_count_new, CAST(sum(metric_sum) AS BIGINT) AS new_total_sum
        FROM new_report GROUP BY ALL) AS n USING (customer_id, metric_key, query_type))"""

SAMPLES = """samples AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS customer_id, 'tenant-' || CAST(user_id % 3 AS VARCHAR) AS customer_name,
    event_type || list_extract(['_success', '_total_duration', ''], CAST(event_id % 3 AS INTEGER) + 1) AS metric_key,
    CASE WHEN user_id % 2 = 0 THEN 'old' ELSE 'new' END AS schema_type,
    CASE WHEN user_id % 2 = 0 THEN 'direct_table' ELSE 'through_view' END AS access_type,
    value AS seconds
  FROM events)"""

METRIC = "customer_id, customer_name, metric_key"


def summary_sql(value: str, tails: bool = False) -> str:
    text = f"""count(*) AS runs, min({value}) AS min, max({value}) AS max, round(avg({value}), 6) AS avg,
  round(coalesce(stddev_samp({value}), 0), 6) AS stdev, round(median({value}), 6) AS median"""
    if tails:
        for name, share in (("p95", "0.95"), ("p99", "0.99")):
            position = f"CAST(floor(count(*) * CAST({share} AS DOUBLE)) AS INTEGER)"
            text += f",\n  list_extract(list_sort(list({value})), {position} + 1) AS {name}"
    return text


SPEEDUPS = f"""{SAMPLES},
speedups AS (
  SELECT {METRIC}, old_avg, new_avg, old_avg / new_avg AS speedup, (old_avg - new_avg) / old_avg * 100 AS improvement_percent
  FROM (SELECT {METRIC}, avg(seconds) FILTER (WHERE schema_type = 'old') AS old_avg,
          avg(seconds) FILTER (WHERE schema_type = 'new') AS new_avg
        FROM samples GROUP BY ALL))"""

OVERHEAD = f"""{SAMPLES},
overhead AS (
  SELECT {METRIC}, direct_mean, view_mean, view_mean - direct_mean AS overhead_seconds,
    (view_mean - direct_mean) / direct_mean * 100 AS overhead_percent
  FROM (SELECT {METRIC}, avg(seconds) FILTER (WHERE access_type = 'direct_table') AS direct_mean,
          avg(seconds) FILTER (WHERE access_type = 'through_view') AS view_mean
        FROM samples GROUP BY ALL))"""

SPEEDUP_SUMMARY = """count(*) AS metrics_count, round(avg(speedup), 6) AS avg_speedup,
  round(min(speedup), 6) AS min_speedup, round(max(speedup), 6) AS max_speedup"""

GRID = f"""spans AS (
  SELECT customer_id, CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM raw GROUP BY customer_id),
days AS (
  SELECT customer_id, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS event_date FROM spans),
grid AS (
  SELECT customer_id, unnest(generate_series(CAST(event_date AS TIMESTAMP),
    CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL {CHUNK_MINUTES} MINUTE,
    INTERVAL {CHUNK_MINUTES} MINUTE)) AS chunk_start FROM days),
chunk_counts AS (
  SELECT customer_id, date_trunc('hour', ts) AS chunk_start, count(*) AS raw_rows,
    count(DISTINCT (date_trunc('minute', ts), client, session)) AS agg_rows
  FROM raw GROUP BY ALL),
chunk_rows AS (
  SELECT customer_id, chunk_start, coalesce(raw_rows, 0) AS raw_rows, coalesce(agg_rows, 0) AS agg_rows
  FROM grid LEFT JOIN chunk_counts USING (customer_id, chunk_start))"""

LOG = f"""{RAW},
{GRID},
stages AS (
  SELECT customer_id + 101 AS tenant, chunk_start, raw_rows, agg_rows,
    CAST(date_diff('hour', TIMESTAMP '{START}', chunk_start) AS INTEGER) + 1 AS chunk_no, customer_id,
    100 + raw_rows * 13 AS fetched, 150 + raw_rows * 13 + agg_rows * 7 AS transformed,
    175 + raw_rows * 13 + agg_rows * 10 AS inserted,
    agg_rows > 0 AND raw_rows % 11 <> 0 AS is_complete
  FROM chunk_rows),
log_chunks AS (
  SELECT tenant AS customer_id, chunk_no, strftime(chunk_start, '%H:%M') || '-' || strftime(chunk_start, '%H') || ':59' AS period,
    TIMESTAMP '2024-03-01 00:00:00' + to_days(customer_id * 2) + to_minutes(chunk_no) AS started,
    is_complete, agg_rows > 0 AS has_rows,
    CASE WHEN agg_rows > 0 THEN raw_rows END AS raw_rows, CASE WHEN agg_rows > 0 THEN agg_rows END AS agg_rows,
    CASE WHEN agg_rows > 0 THEN CAST(format('{{:.2f}}', raw_rows / agg_rows) AS DOUBLE) END AS ratio,
    fetched / 1000 AS aggregate_seconds, (transformed - fetched) / 1000 AS transform_seconds,
    (inserted - transformed - 5) / 1000 AS insert_seconds, (inserted + 1) / 1000 AS total_seconds,
    inserted + 1 AS total_ms
  FROM stages)"""


def build() -> dict[str, str]:
    texts: dict[str, str] = {}
    for kind in ("int", "float"):
        texts[f"discover_{kind}_keys"] = f"""WITH {BASE}
SELECT customer_id, kind, key FROM mapping WHERE kind = '{kind}'"""
    texts["discover_tag_keys"] = f"WITH {RAW},\n{TAGS}\nSELECT customer_id, 'string' AS kind, key FROM tags"
    texts["key_lists"] = f"""WITH {BASE}
SELECT customer_id, kind, group_no, array_to_string(list_sort(list(DISTINCT key)), ',') AS keys
FROM entries WHERE trim(key) <> '' GROUP BY ALL"""
    texts["distinct_tenants"] = f"WITH {RAW} SELECT DISTINCT CAST(ts AS DATE) AS event_date, customer_id FROM raw"
    texts["day_list"] = f"WITH {RAW},\n{GRID}\nSELECT customer_id, event_date FROM days"
    texts["chunk_grid"] = f"WITH {RAW},\n{GRID}\nSELECT customer_id, chunk_start, raw_rows FROM chunk_rows"
    texts["assign_columns"] = f'WITH {BASE}\nSELECT customer_id, kind, key, idx, kind || idx AS "column" FROM mapping'
    texts["reverse_mapping"] = f'WITH {BASE}\nSELECT customer_id, kind, kind || idx AS "column", key FROM mapping'
    texts["max_columns"] = f"""WITH {BASE}
SELECT kind, max(n) AS max_columns FROM (SELECT customer_id, kind, count(*) AS n FROM mapping GROUP BY ALL) GROUP BY kind"""
    texts["normalise_tags"] = f"""WITH {RAW},
{TAGS}
SELECT customer_id, string_agg(key, ',' ORDER BY key DESC) AS keys, CAST(count(*) AS INTEGER) AS key_count,
  TRUE AS count_was_wrong FROM tags GROUP BY customer_id"""
    texts["tag_columns"] = f"""WITH {RAW},
{TAGS}
SELECT customer_id, 'string' AS kind, key, CAST(row_number() OVER w AS INTEGER) AS idx, 'string' || row_number() OVER w AS "column"
FROM tags WINDOW w AS (PARTITION BY customer_id ORDER BY key DESC)"""
    texts["string_columns"] = f"""WITH {RAW},
{TAGS}
SELECT CAST(max(n) AS INTEGER) AS string_columns FROM (SELECT customer_id, count(*) AS n FROM tags GROUP BY customer_id)"""
    for grain in ("minute", "hour", "day"):
        texts[f"flatten_{grain}"] = f"WITH {flat(grain)}\nSELECT * FROM flat"
    texts["flatten_day_sum"] = f"WITH {flat('day', 'sum')}\nSELECT * FROM flat"
    texts["unmapped_keys"] = f"""WITH {BASE},
known AS (SELECT DISTINCT customer_id, kind, key FROM entries WHERE ts < TIMESTAMP '{SHORT_END}' AND trim(key) <> '')
SELECT customer_id, kind, key, count(*) AS entries FROM entries
WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.customer_id = entries.customer_id AND known.kind = entries.kind
  AND known.key = entries.key) GROUP BY ALL"""
    stats = f"""{RAW},
stats AS (
  SELECT customer_id, CAST(sum(n) AS BIGINT) AS raw_rows, count(*) AS agg_rows, count(DISTINCT t) AS chunks_with_rows,
    sum(n) / count(*) AS compression_factor
  FROM (SELECT customer_id, date_trunc('minute', ts) AS t, client, session, count(*) AS n FROM raw GROUP BY ALL)
  GROUP BY customer_id)"""
    texts["compression_stats"] = f"""WITH {stats}
SELECT customer_id, raw_rows, agg_rows, chunks_with_rows, round(compression_factor, 6) AS compression_factor FROM stats"""
    texts["run_totals"] = f"""WITH {stats}
SELECT count(*) AS tenants, CAST(sum(raw_rows) AS BIGINT) AS raw_rows, CAST(sum(agg_rows) AS BIGINT) AS agg_rows,
  CAST(sum(chunks_with_rows) AS BIGINT) AS chunks_with_rows FROM stats"""

    for path, values in (("map", RAW_VALUES), ("flat", CELL_VALUES)):
        flow = f"AND event_type = '{DIMS_FLOW}'" if path == "map" else ""
        texts[f"metric_{path}_dims"] = metric_sql(values, "dims", DIMS_METRIC, extra=f"AND ival > 0 {flow}")
        texts[f"metric_{path}_country"] = metric_sql(values, "country", COUNT_METRIC)
        texts[f"metric_{path}_minute"] = metric_sql(values, "minute", COUNT_METRIC)
        texts[f"metric_{path}_minute_window"] = metric_sql(values, "minute", COUNT_METRIC, WINDOW_END)
    texts["metric_direct_dims"] = UNFILTERED
    texts["metric_view_dims"] = UNFILTERED

    named = f"""{CELL_VALUES},
named AS (
  SELECT groups.t AS "timestampMs", groups.client AS "clientId", groups.session AS "sessionId",
    coalesce(max(CASE WHEN key = 'event_count' THEN ival END), 0) AS event_count,
    coalesce(max(CASE WHEN key = 'f_1_view_success' THEN ival END), 0) AS view_success,
    coalesce(max(CASE WHEN key = 'retries' THEN ival END), 0) AS retries,
    round(CAST(CAST(coalesce(max(CASE WHEN key = 'view_value' THEN dval END), 0) AS FLOAT) AS DOUBLE), 4) AS view_value
  FROM groups JOIN cells USING (t, client, session, customer_id)
  WHERE customer_id = {TENANT} GROUP BY ALL)"""
    texts["tenant_view_rows"] = f"WITH {named} SELECT * FROM named"
    texts["view_sample_row"] = f"""WITH {named}
SELECT * FROM named ORDER BY "timestampMs", "clientId", "sessionId" LIMIT 1"""
    texts["verify_view"] = f"WITH {named} SELECT count(*) AS row_count, count(*) > 0 AS has_data FROM named"
    texts["tenant_summary"] = f"""WITH {BASE},
{groups('minute')}
SELECT customer_id, row_count, row_count > 0 AS has_data, int_metrics, float_metrics
FROM (SELECT customer_id, count(*) AS row_count FROM groups GROUP BY customer_id)
JOIN (SELECT customer_id, count(*) FILTER (WHERE kind = 'int') AS int_metrics,
  count(*) FILTER (WHERE kind = 'float') AS float_metrics FROM mapping GROUP BY customer_id) USING (customer_id)"""
    profile = f"""{BASE},
{cells('minute')},
tenants AS (SELECT DISTINCT customer_id FROM raw),
positions AS (
  SELECT 'int' AS kind, CAST(unnest(range(1, {INT_COLUMNS + 1})) AS INTEGER) AS idx
  UNION ALL SELECT 'float', CAST(unnest(range(1, {FLOAT_COLUMNS + 1})) AS INTEGER)),
profile AS (
  SELECT tenants.customer_id, positions.kind || positions.idx AS "column", positions.kind AS column_class,
    count(*) FILTER (WHERE ival <> 0 OR dval <> 0) AS used_rows,
    round(coalesce(sum(coalesce(CAST(ival AS DOUBLE), CAST(CAST(dval AS FLOAT) AS DOUBLE))), 0), 3) AS total
  FROM tenants CROSS JOIN positions LEFT JOIN cells ON cells.customer_id = tenants.customer_id
    AND cells.kind = positions.kind AND cells.idx = positions.idx GROUP BY ALL)"""
    texts["column_profile"] = f"WITH {profile} SELECT * FROM profile"
    texts["class_profile"] = f"""WITH {profile}
SELECT column_class, count(*) AS columns, count(*) FILTER (WHERE used > 0) AS columns_in_use, CAST(sum(used) AS BIGINT) AS used_cells
FROM (SELECT column_class, "column", sum(used_rows) AS used FROM profile GROUP BY ALL) GROUP BY column_class"""
    texts["rows_by_month"] = f"""WITH {RAW},
{groups('minute')}
SELECT CAST(strftime(t, '%Y%m') AS INTEGER) AS month, customer_id, count(*) AS rows FROM groups GROUP BY ALL"""
    texts["rows_where"] = f"""WITH {CELL_VALUES}
SELECT count(*) AS rows FROM metrics WHERE idx = 1 AND ival > 0 AND platform = 'ios'"""
    kept = {"timestampMs": "ts", "clientId": "client", "sessionId": "session", "customerId": "customer_id", **_GIVEN}
    columns = []
    for field in flat_schema(0).fields:
        kind = field.dataType.simpleString()
        default = "''" if kind == "string" else "0"
        columns.append(f'CAST({kept.get(field.name, default)} AS {_SQL_TYPES[kind]}) AS "{field.name}"')
    texts["kept_columns"] = f"WITH {RAW} SELECT {', '.join(columns)} FROM raw"
    texts["key_presence"] = f"""WITH {BASE}
SELECT customer_id, 'metricIntGroup' || first_group AS first_group, count(*) AS rows
FROM (SELECT customer_id, event_id, min(group_no) AS first_group FROM entries WHERE kind = 'int' AND key = 'retries' GROUP BY ALL)
GROUP BY ALL"""
    texts["map_value_sum"] = f"""WITH {RAW}
SELECT customer_id, count(*) AS rows, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS retries
FROM raw GROUP BY customer_id"""

    texts["metric_flows"] = f"""WITH {BASE},
{FLOWS}
SELECT customer_id, metric_key, flowid, cnt, CAST(flow_rank AS INTEGER) AS flow_rank FROM ranked WHERE flow_rank <= 10"""
    texts["metric_group"] = f"""WITH {BASE},
{FLOWS}
SELECT customer_id, metric_key, flowid, 'metricIntGroup' || group_no AS source_map_column, flow_count > 1 AS has_multiple_flowids
FROM ranked WHERE flow_rank = 1"""
    locator = "customer_id, metric_key, flowid, source_map_column, target_physical_column, has_multiple_flowids"
    texts["metric_locator"] = f"WITH {BASE},\n{FLOWS}\nSELECT {locator} FROM located"
    texts["metric_locator_selected"] = f"""WITH {BASE},
{FLOWS}
SELECT {locator} FROM located WHERE metric_key IN ('event_count', 'retries')"""
    texts["pattern_rows"] = f"""WITH {BASE},
{FLOWS}
SELECT {locator.replace('flowid,', "'ALL' AS flowid,", 1)} FROM located WHERE metric_key = '{COUNT_METRIC}'"""
    for shape, column in (("cell", "t"), ("raw", "ts")):
        bounded = f"WHERE {column} < TIMESTAMP '{WINDOW_END}' AND ival > 0"
        name = "metric_report_minute_window" if shape == "cell" else "metric_report_map_minute_window"
        text = f"WITH {CELL_VALUES}\n{flat_report_sql('minute')}" if shape == "cell" else (
            f"WITH {BASE},\n{FLOWS}\n{map_report_sql('minute', all_flows=True)}"
        )
        texts[name] = text.replace("WHERE ival > 0", bounded).replace("'groupby_minute'", "'groupby_minute_filtered'")
    for shape in SHAPES:
        texts[f"metric_report_{shape}"] = f"WITH {CELL_VALUES}\n{flat_report_sql(shape)}"
        texts[f"metric_report_map_{shape}"] = (
            f"WITH {BASE},\n{FLOWS}\n{map_report_sql(shape, all_flows=shape != 'dims')}"
        )
    texts["validate_totals"] = f"WITH {TOTALS} SELECT * FROM totals"
    texts["validate_groups"] = f"""WITH {VALIDATION}
SELECT customer_id, metric_key, query_type, "deviceCategory", "countryIso", platform,
  o.metric_sum AS old_sum, n.metric_sum AS new_sum, abs(coalesce(o.metric_sum, 0) - coalesce(n.metric_sum, 0)) AS difference
FROM old_report AS o FULL JOIN new_report AS n
  USING (customer_id, metric_key, query_type, "deviceCategory", "countryIso", platform)
WHERE o.metric_sum IS DISTINCT FROM n.metric_sum"""
    texts["validation_summary"] = f"""WITH {TOTALS}
SELECT customer_id, count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE NOT passed) AS failed, bool_and(passed) AS all_passed FROM totals GROUP BY customer_id"""

    texts["timing_metric_stats"] = f"""WITH {SAMPLES}
SELECT {METRIC}, schema_type, {summary_sql('seconds')} FROM samples GROUP BY {METRIC}, schema_type"""
    texts["timing_speedups"] = f"""WITH {SPEEDUPS}
SELECT {METRIC}, round(old_avg, 6) AS old_avg, round(new_avg, 6) AS new_avg, round(speedup, 6) AS speedup,
  round(improvement_percent, 6) AS improvement_percent FROM speedups"""
    texts["timing_by_tenant"] = f"WITH {SPEEDUPS}\nSELECT customer_name, {SPEEDUP_SUMMARY} FROM speedups GROUP BY customer_name"
    texts["timing_by_type"] = f"""WITH {SPEEDUPS}
SELECT CASE WHEN metric_key LIKE '%success%' THEN 'success_count'
    WHEN metric_key LIKE '%total_duration%' OR metric_key LIKE '%time%' THEN 'duration' ELSE 'other' END AS metric_type,
  {SPEEDUP_SUMMARY} FROM speedups GROUP BY metric_type"""
    sides = ",\n  ".join(
        f"max({n}) FILTER (WHERE schema_type = '{s}') AS {s}_{n}"
        for s in ("old", "new")
        for n in ("runs", "avg", "min", "max", "median", "stdev")
    )
    texts["timing_overall"] = f"""WITH {SAMPLES},
stats AS (SELECT schema_type, {summary_sql('seconds')} FROM samples GROUP BY schema_type),
means AS (SELECT avg(seconds) FILTER (WHERE schema_type = 'old') AS o, avg(seconds) FILTER (WHERE schema_type = 'new') AS n FROM samples)
SELECT {sides},
  round(max(means.o / means.n), 6) AS overall_speedup, round(max((means.o - means.n) / means.o * 100), 6) AS improvement_percent
FROM stats CROSS JOIN means"""
    texts["view_timing_stats"] = f"""WITH {SAMPLES}
SELECT {METRIC}, access_type, {summary_sql('seconds', tails=True)} FROM samples GROUP BY {METRIC}, access_type"""
    texts["view_overhead"] = f"""WITH {OVERHEAD}
SELECT {METRIC}, round(direct_mean, 6) AS direct_mean, round(view_mean, 6) AS view_mean,
  round(overhead_seconds, 6) AS overhead_seconds, round(overhead_percent, 6) AS overhead_percent FROM overhead"""
    overall = summary_sql("mean", tails=True)
    for name in ("min(mean)", "max(mean)"):
        overall = overall.replace(f"{name} AS", f"round({name}, 6) AS")
    for name in ("p95", "p99"):
        overall = overall.replace(f"+ 1) AS {name}", f"+ 1), 6) AS {name}")
    overall = overall.replace("list_extract(", "round(list_extract(")
    texts["view_overall"] = f"""WITH {OVERHEAD},
means AS (SELECT 'direct_table' AS access_type, direct_mean AS mean FROM overhead
  UNION ALL SELECT 'through_view', view_mean FROM overhead)
SELECT access_type, {overall},
  (SELECT round(avg(overhead_percent), 6) FROM overhead) AS avg_overhead_percent
FROM means GROUP BY access_type"""
    texts["view_by_tenant"] = f"""WITH {OVERHEAD}
SELECT customer_name, round(avg(direct_mean), 6) AS direct_mean, round(avg(view_mean), 6) AS view_mean,
  round(avg(overhead_percent), 6) AS overhead_percent FROM overhead GROUP BY customer_name"""

    texts["log_events"] = f"""WITH {LOG}
SELECT 'tenant' AS event, count(DISTINCT customer_id) AS events FROM log_chunks
UNION ALL SELECT 'start', count(*) FROM log_chunks
UNION ALL SELECT 'fetched', count(*) FROM log_chunks
UNION ALL SELECT name, count(*) FROM log_chunks, (SELECT unnest(['compression', 'transformed', 'inserting', 'completed']) AS name)
  WHERE has_rows GROUP BY name
UNION ALL SELECT 'inserted', count(*) FROM log_chunks WHERE is_complete"""
    texts["log_chunks"] = f"""WITH {LOG}
SELECT customer_id, chunk_no, period, started, raw_rows, agg_rows, ratio, aggregate_seconds, transform_seconds,
  insert_seconds, total_seconds FROM log_chunks WHERE is_complete"""
    texts["log_tenant_stats"] = f"""WITH {LOG},
begun AS (SELECT customer_id, min(started) AS first FROM log_chunks GROUP BY customer_id),
totals AS (
  SELECT customer_id, CAST(sum(raw_rows) AS BIGINT) AS total_raw_rows, CAST(sum(agg_rows) AS BIGINT) AS total_agg_rows,
    count(*) AS total_chunks, round(avg(aggregate_seconds), 6) AS avg_aggregate_seconds,
    round(avg(transform_seconds), 6) AS avg_transform_seconds, round(avg(insert_seconds), 6) AS avg_insert_seconds,
    round(avg(total_seconds), 6) AS avg_total_seconds, round(avg(ratio), 6) AS avg_compression_ratio,
    max(started + to_milliseconds(total_ms)) AS finished
  FROM log_chunks WHERE is_complete GROUP BY customer_id)
SELECT totals.* EXCLUDE (finished), date_diff('millisecond', begun.first, finished) / 1000 AS total_time_seconds,
  CAST(floor(date_diff('millisecond', begun.first, finished) / 60000) AS INTEGER) || 'm '
    || CAST(round(date_diff('millisecond', begun.first, finished) % 60000 / 1000) AS INTEGER) || 's' AS total_time_text
FROM totals JOIN begun USING (customer_id)"""
    return texts | oracle_stores.build()
