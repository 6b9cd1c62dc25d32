"""SQL of the queries in stores."""

from __future__ import annotations

from widefold.model import STANDARD_COLUMNS, flat_schema, group_columns

CUT = "2024-01-16 00:00:00"
CHANGED_CLIENT = "7"
HALF_DAYS = ["2024-01-01 00:00:00", "2024-01-10 12:00:00", "2024-01-20 12:00:00", "2024-01-31 00:00:00"]


def build() -> dict[str, str]:
    from checks import oracle

    base, raw = oracle.BASE, oracle.RAW
    texts: dict[str, str] = {}
    kept = (
        f"FROM events WHERE (ts < TIMESTAMP '{CUT}' AND event_type <> 'click')"
        f" OR (ts >= TIMESTAMP '{CUT}' AND event_type <> 'view')"
    )
    texts["load_two_days"] = f"""WITH {base.replace('FROM events', kept)},
{oracle.cells('minute')}
SELECT customer_id, kind, key,
  round(sum(CASE WHEN kind = 'int' THEN CAST(ival AS DOUBLE) ELSE CAST(CAST(dval AS FLOAT) AS DOUBLE) END), 3) AS total
FROM cells GROUP BY ALL"""
    between = f"ts >= TIMESTAMP '{HALF_DAYS[1]}' AND ts < TIMESTAMP '{HALF_DAYS[2]}'"
    texts["load_half_days"] = all_rows("minute", "FROM events")
    texts["load_vanished_tenant"] = all_rows("minute", f"FROM events WHERE NOT (user_id % 3 = 1 AND {between})")
    texts["load_one_tenant"] = all_rows("hour", f"FROM events WHERE NOT (user_id % 3 = 1 AND event_type = 'click' AND {between})")
    texts["discover_in_steps"] = f"""WITH {oracle.BASE},
{oracle.TAGS}
SELECT DISTINCT customer_id, kind, CAST(group_no AS INTEGER) AS group_no, key FROM entries WHERE trim(key) <> ''
UNION ALL SELECT customer_id, 'string', 1, key FROM tags"""
    texts["metric_by_catalogue"] = oracle.metric_sql(
        oracle.RAW_VALUES, "dims", oracle.DIMS_METRIC, extra=f"AND ival > 0 AND event_type = '{oracle.DIMS_FLOW}'"
    )
    texts["flatten_hour_from_minutes"] = f"WITH {oracle.flat('hour')}\nSELECT * FROM flat"
    texts["flatten_day_from_hours"] = f"WITH {oracle.flat('day')}\nSELECT * FROM flat"
    texts["stored_view"] = tenant_view()
    texts["find_difference"] = f"""WITH {oracle.BASE}
SELECT date_trunc('minute', ts) AS "timestampMs", client AS "clientId", session AS "sessionId", e.customer_id AS "customerId",
  'int' || max(idx) AS "column", CAST(count(*) AS VARCHAR) AS left_value,
  CAST(count(*) + count_if(event_type = 'purchase') AS VARCHAR) AS right_value
FROM entries e JOIN mapping m ON m.customer_id = e.customer_id AND m.kind = 'int' AND m.key = 'event_count'
WHERE e.key = 'event_count' AND client = '{CHANGED_CLIENT}'
GROUP BY 1, 2, 3, 4 HAVING count_if(event_type = 'purchase') > 0"""
    for name in ("mapping_from_json", "mapping_from_tables"):
        texts[name] = f'WITH {base}\nSELECT customer_id, kind, key, idx, kind || idx AS "column" FROM mapping'
    flat_rows = f"""WITH {raw},
{oracle.groups('minute')}"""
    made = "customer_id, count(*) AS rows, CAST(0 AS BIGINT) AS int3, count(*) AS floats, count(*) AS blank_browsers"
    texts["created_table"] = f"{flat_rows}\nSELECT {made} FROM groups GROUP BY customer_id"
    texts["created_table_v2"] = f"{flat_rows}\nSELECT {made}, count(*) AS blank_strings FROM groups GROUP BY customer_id"
    for name, times in (("appended_twice", 2), ("replaced_days", 1)):
        texts[name] = f"""WITH {base},
{oracle.groups('minute')},
{oracle.cells('minute')}
SELECT customer_id, {times} * count(*) AS rows, CAST({times} * coalesce(sum(ival), 0) AS BIGINT) AS int1
FROM groups LEFT JOIN (SELECT * FROM cells WHERE kind = 'int' AND idx = 1) AS firsts
  USING (t, client, session, customer_id) GROUP BY customer_id"""
    for key in ("client", "hour"):
        texts[f"file_overlaps_{key}"] = f"WITH {raw}\nSELECT customer_id, CAST(0 AS BIGINT) AS overlaps FROM raw GROUP BY customer_id"
    for grain in ("minute", "hour", "day"):
        texts[f"preagg_{grain}"] = preagg(grain)
    texts["sum_map_long"] = f"""WITH {base}
SELECT date_trunc('day', ts) AS "timestampMs", client AS "clientId", session AS "sessionId", customer_id AS "customerId",
  CAST(group_no AS INTEGER) AS group_no, key, kind,
  CASE WHEN kind = 'int' THEN CAST(sum(ival) AS DOUBLE) ELSE round(sum(dval), 4) END AS value
FROM entries GROUP BY 1, 2, 3, 4, kind, group_no, key"""
    texts["rows_of_a_day"] = f"""WITH {raw}
SELECT customer_id, count(*) AS rows FROM raw WHERE CAST(ts AS DATE) = DATE '2024-01-05' GROUP BY customer_id"""
    stats = f"""WITH {oracle.SAMPLES}
SELECT {oracle.METRIC}, schema_type, {oracle.summary_sql('seconds')} FROM samples GROUP BY {oracle.METRIC}, schema_type"""
    texts["timings_from_csv"] = texts["results_from_json"] = stats
    return texts


def tenant_view() -> str:
    """The flat rows of a tenant with its metrics under their own names."""
    from checks import oracle

    kinds = ["click", "error", "purchase", "signup", "view"]
    ints = sorted(["event_count", "retries", *[f"f_{oracle.TENANT}_{k}_{m}" for k in kinds for m in ("success", "total_duration")]])
    shown = [f'int{i} AS "{name}"' for i, name in enumerate(ints, 1)]
    shown += [f'float{i} AS "{k}_value"' for i, k in enumerate(kinds, 1)]
    standard = ", ".join(STANDARD_COLUMNS)
    return f"WITH {oracle.flat('minute')}\nSELECT {standard}, {', '.join(shown)} FROM flat WHERE customerId = {oracle.TENANT}"


def all_rows(grain: str, rows: str) -> str:
    """Every group with every key of its tenant, 0 where the group lacks it; rows: which events are there."""
    from checks import oracle

    base = oracle.BASE.replace("FROM events", rows, 1)
    return f"""WITH {base},
{oracle.groups(grain)},
{oracle.cells(grain)},
names AS (SELECT DISTINCT CAST(user_id % 3 AS INTEGER) AS customer_id, kind, key FROM (
  {oracle.BASE.join(["WITH ", " SELECT user_id, kind, key FROM entries WHERE trim(key) <> ''"])}))
SELECT groups.t AS "timestampMs", groups.client AS "clientId", groups.session AS "sessionId", groups.customer_id AS "customerId",
  groups.s.platform AS platform, groups.s.appVersion AS "appVersion", names.kind, names.key,
  round(CAST(CASE WHEN names.kind = 'int' THEN coalesce(CAST(ival AS DOUBLE), 0)
    ELSE coalesce(CAST(CAST(dval AS FLOAT) AS DOUBLE), 0) END AS DOUBLE), 3) AS value
FROM groups JOIN names USING (customer_id)
LEFT JOIN cells ON cells.t = groups.t AND cells.client = groups.client AND cells.session = groups.session
  AND cells.customer_id = groups.customer_id AND cells.kind = names.kind AND cells.key = names.key"""


def preagg(grain: str) -> str:
    from checks import oracle

    given = {"timestampMs": "t", "clientId": "client", "sessionId": "session", "customerId": "customer_id"}
    columns = []
    for field in flat_schema(0).fields:
        kind = field.dataType.simpleString()
        if field.name in given:
            columns.append(f'{given[field.name]} AS "{field.name}"')
        elif field.name in oracle._GIVEN:
            columns.append(f'CAST(s.{field.name} AS {oracle._SQL_TYPES[kind]}) AS "{field.name}"')
        else:
            default = "''" if kind == "string" else "0"
            columns.append(f'CAST({default} AS {oracle._SQL_TYPES[kind]}) AS "{field.name}"')
    maps = []
    for kind, shown in (("int", "CAST(isum AS VARCHAR)"), ("float", "CAST(CAST(dsum AS DECIMAL(18,3)) AS VARCHAR)")):
        for n, name in enumerate(group_columns(kind), 1):
            maps.append(
                f"coalesce(string_agg(key || '=' || {shown}, ',' ORDER BY key)"
                f" FILTER (WHERE kind = '{kind}' AND group_no = {n}), '') AS \"{name}\""
            )
    names = ", ".join(f'"{g}"' for kind in ("int", "float") for g in group_columns(kind))
    return f"""WITH {oracle.BASE},
{oracle.groups(grain)},
sums AS (
  SELECT date_trunc('{grain}', ts) AS t, client, session, customer_id, kind, group_no, key,
    CAST(sum(ival) AS BIGINT) AS isum, sum(dval) AS dsum
  FROM entries GROUP BY ALL),
maps AS (SELECT t, client, session, customer_id, {', '.join(maps)} FROM sums GROUP BY ALL)
SELECT {', '.join(columns)}, {names} FROM groups JOIN maps USING (t, client, session, customer_id)"""
