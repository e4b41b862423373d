"""The same rows as SQL over the flat ``events`` table, for an independent engine."""

from __future__ import annotations

# One row per event: helper values, identity columns, and each parameter as a column.
EVENTS = """
h AS (
  SELECT event_id, event_type AS event_name, value AS amount, user_id AS uid, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) AS us,
         (epoch_us(ts) // 1000000 + 43200) // 86400 AS sid,
         event_id % 101 <> 0 AS filled
  FROM events
),
e AS (
  SELECT event_id, event_name, us AS event_timestamp, k, amount, uid, filled,
         strftime(ts, '%Y-%m-%d') AS event_date,
         CASE WHEN event_id % 50 <> 0 THEN 'p' || uid END AS user_pseudo_id,
         CASE WHEN event_id % 4 = 0 THEN 'u' || uid END AS user_id,
         CASE WHEN filled AND event_id % 11 <> 0
              THEN 'https://shop.example/' || event_name || '/' || (k % 10) END AS page_location,
         CASE WHEN filled AND k % 3 = 0 THEN 'https://ref.example/' || (k % 7) END AS page_referrer,
         CASE WHEN filled AND event_id % 37 <> 0 THEN sid END AS ga_session_id,
         CASE WHEN filled AND event_id % 37 <> 0 THEN sid - 19722 END AS ga_session_number,
         CASE WHEN filled THEN CASE WHEN k >= 50 THEN '1' ELSE '0' END END AS session_engaged,
         CASE WHEN filled THEN k * 100 END AS engagement_time_msec,
         CASE WHEN filled AND event_name = 'purchase' THEN amount END AS value,
         CASE WHEN filled AND event_id % 13 = 0 THEN us // 1000 END AS custom_timestamp,
         CASE WHEN filled AND event_name = 'purchase' THEN '[]' END AS items_param,
         CASE WHEN event_name = 'purchase' THEN k % 4 ELSE 0 END AS item_count,
         CASE WHEN event_id % 9 <> 0 THEN 'os' || (event_id % 2) END AS operating_system,
         CASE WHEN event_id % 9 <> 0 THEN 'b' || (uid % 4) END AS browser,
         CASE WHEN event_id % 9 <> 0 THEN
              CASE uid % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END
         END AS category,
         'K' || (uid % 2) AS continent, 'C' || (uid % 5) AS country, 'R' || (event_id % 3) AS region,
         CASE WHEN event_id % 7 <> 0 THEN 'm' || (k % 3) END AS medium,
         CASE WHEN event_id % 7 <> 0 THEN 'n' || (k % 4) END AS name,
         CASE WHEN event_id % 7 <> 0 THEN 's' || (k % 5) END AS source,
         CASE WHEN event_id % 3 = 0 THEN 'cs' || (k % 4) END AS manual_source,
         CASE WHEN event_id % 3 = 0 THEN 'g' || event_id END AS gclid
  FROM h
)"""

# One row per item of a purchase.
ITEMS = """
i AS (
  SELECT e.*, 'sku' || ((k + n) % 20) AS item_id
  FROM e JOIN (SELECT unnest([1, 2, 3]) AS n) AS numbers ON n <= item_count
)"""

# One row per (event, parameter) in the four typed slots.
PARAMETERS = [
    ("page_location", "string_value", "page_location"),
    ("page_referrer", "string_value", "page_referrer"),
    ("ga_session_id", "int_value", "ga_session_id"),
    ("ga_session_number", "int_value", "ga_session_number"),
    ("session_engaged", "string_value", "session_engaged"),
    ("engagement_time_msec", "int_value", "engagement_time_msec"),
    ("value", "double_value", "value"),
    ("custom_timestamp", "int_value", "custom_timestamp"),
    ("items", "string_value", "items_param"),
]
SLOT_TYPES = {
    "string_value": "VARCHAR",
    "int_value": "BIGINT",
    "float_value": "DOUBLE",
    "double_value": "DOUBLE",
}


def _entry(key: str, slot: str, column: str) -> str:
    slots = ", ".join(
        f"CAST({column if name == slot else 'NULL'} AS {kind}) AS {name}"
        for name, kind in SLOT_TYPES.items()
    )
    return (
        f"SELECT event_id, '{key}' AS key, {slots}, CAST({column} AS VARCHAR) AS text_value "
        f"FROM e WHERE {column} IS NOT NULL"
    )


LONG = "p AS (\n  " + "\n  UNION ALL ".join(_entry(*entry) for entry in PARAMETERS) + "\n)"

# Session features, spread over all events of the session.
SESSIONS = """
s AS (
  SELECT *, user_pseudo_id || ga_session_id AS session_id,
         coalesce(custom_timestamp, event_timestamp // 1000) AS ordering_timestamp
  FROM e WHERE user_pseudo_id IS NOT NULL AND ga_session_id IS NOT NULL
),
f AS (
  SELECT session_id, event_date AS session_date, ga_session_id, user_pseudo_id, session_engaged,
         max(ga_session_number) OVER w AS ga_session_number,
         max(user_id) OVER w AS user_id,
         min(ordering_timestamp) OVER w AS session_start_timestamp,
         max(ordering_timestamp) OVER w AS session_end_timestamp,
         first_value(page_location) OVER w AS session_landing_page,
         last_value(page_location) OVER w AS session_exit_page,
         first_value(page_referrer) OVER w AS session_referrer_page,
         first_value(category) OVER w AS category,
         first_value(operating_system) OVER w AS operating_system,
         first_value(browser) OVER w AS browser,
         first_value(continent) OVER w AS continent,
         first_value(country) OVER w AS country,
         first_value(region) OVER w AS region,
         first_value(medium IGNORE NULLS) OVER w AS medium,
         first_value(name IGNORE NULLS) OVER w AS name,
         first_value(source IGNORE NULLS) OVER w AS source,
         first_value(manual_source IGNORE NULLS) OVER w AS manual_source,
         first_value(gclid IGNORE NULLS) OVER w AS gclid
  FROM s
  WINDOW w AS (PARTITION BY session_id ORDER BY ordering_timestamp, event_timestamp
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
r AS (
  SELECT * EXCLUDE (session_engaged), coalesce(max(session_engaged) = '1', false) AS is_engaged_session
  FROM f GROUP BY ALL
)"""

DAY = "2024-01-15"


def _over_events(body: str) -> str:
    return f"WITH {EVENTS}\n{body}"


def _over_items(body: str) -> str:
    return f"WITH {EVENTS},{ITEMS}\n{body}"


def _over_params(body: str) -> str:
    return f"WITH {EVENTS},\n{LONG}\n{body}"


def _sessions(columns: str) -> str:
    return f"WITH {EVENTS},{SESSIONS}\nSELECT session_id, session_date, {columns} FROM r"


NAMES = "SELECT event_id, event_name, event_timestamp FROM e WHERE "

PARAM_TEXTS = """page_location, page_referrer, CAST(ga_session_id AS VARCHAR) AS ga_session_id,
  CAST(ga_session_number AS VARCHAR) AS ga_session_number, session_engaged,
  CAST(engagement_time_msec AS VARCHAR) AS engagement_time_msec,
  CAST(value AS VARCHAR) AS value, CAST(custom_timestamp AS VARCHAR) AS custom_timestamp"""

SESSION_ID = "user_pseudo_id || ga_session_id AS session_id"


def _purchases(extra_condition: str) -> str:
    """Flattened purchases; their item ids come from a join with the exploded items."""
    return _over_items(f"""
    , listed AS (
      SELECT event_id, string_agg(item_id, ',' ORDER BY item_id) AS item_ids FROM i GROUP BY event_id
    )
    SELECT user_pseudo_id, user_id, {SESSION_ID}, event_name, event_date, event_timestamp,
           CAST(0 AS BIGINT) AS batch_event_index, country, CAST(NULL AS VARCHAR) AS city, browser,
           item_count, coalesce(item_ids, '') AS item_ids, 'plan' || (uid % 2) AS plan, {PARAM_TEXTS}
    FROM e LEFT JOIN listed USING (event_id)
    WHERE event_name = 'purchase' AND filled {extra_condition}""")


def _summary(condition: str) -> str:
    counted = " + ".join(f"({column} IS NOT NULL)::BIGINT" for _, _, column in PARAMETERS)
    return _over_events(
        f"SELECT event_id, event_name, event_timestamp, {counted} AS param_count, country "
        f"FROM e WHERE {condition}"
    )


def _marks(mark: str) -> str:
    return (
        f"SELECT event_timestamp, event_name, event_date, page_location, {mark} AS mark "
        "FROM e WHERE filled"
    )


SECOND_ON_DAY = f"CASE WHEN event_date = '{DAY}' THEN 'second' ELSE 'first' END"

FIELD_NAMES = (
    "custom_timestamp,engagement_time_msec,ga_session_id,ga_session_number,"
    "page_location,page_referrer,session_engaged,value"
)

ALL_SESSION_COLUMNS = """session_start_timestamp, session_end_timestamp, ga_session_id,
  ga_session_number, user_pseudo_id, user_id, session_landing_page, session_exit_page,
  session_referrer_page, '' AS term, {gclid} AS gclid, medium, category, region,
  is_engaged_session"""

# The awkward variant of the events, and sessions made of them.
AWKWARD = f"""{EVENTS},
a AS (
  SELECT * REPLACE (CASE WHEN filled AND event_id % 13 = 0
    THEN event_timestamp // 1000 + (event_id % 5 - 2) * 3600000 END AS custom_timestamp) FROM e
)"""
AWKWARD_SESSIONS = AWKWARD + "," + SESSIONS.replace("FROM e WHERE", "FROM a WHERE")

# Items of a session's day.
ITEMS_BY_DAY = _over_items(f"""
        SELECT user_pseudo_id, {SESSION_ID},
               event_timestamp // 86400000000 * 86400000000 AS event_timestamp,
               count(*) AS item_count, string_agg(item_id, ',' ORDER BY item_id) AS item_ids
        FROM i WHERE filled GROUP BY ALL""")

ORACLE = {
    "filter_name": _over_events(NAMES + "event_name = 'purchase'"),
    "filter_list": _over_events(NAMES + "event_name IN ('purchase', 'signup')"),
    "filter_pattern": _over_events(NAMES + "event_name LIKE '_i%'"),
    "default_columns": """
        SELECT event_id, CAST(0 AS BIGINT) AS batch_event_index,
               CAST(0 AS BIGINT) AS batch_page_id, CAST(0 AS BIGINT) AS batch_ordering_id
        FROM events""",
    "params_long": _over_params(
        "SELECT event_id, key, string_value, int_value, float_value, double_value FROM p"
    ),
    "param_value_text": _over_params("SELECT event_id, key, text_value AS value FROM p"),
    "param_keys": _over_params("SELECT DISTINCT key FROM p WHERE key <> 'items'"),
    "param_lookup": _over_events(
        "SELECT event_id, page_location, ga_session_id, value, "
        "CAST(NULL AS VARCHAR) AS session_as_string FROM e"
    ),
    "pivot_params": _over_events(f"SELECT event_id, {PARAM_TEXTS} FROM e WHERE filled"),
    "pivot_merge_duplicates": _over_events(
        f"SELECT event_timestamp, event_name, {SESSION_ID}, {PARAM_TEXTS} FROM e WHERE filled"
    ),
    "pivot_excludes_items": _over_events(
        f"SELECT event_timestamp, '{FIELD_NAMES}' AS field_names "
        "FROM e WHERE event_name = 'purchase' AND filled AND k % 2 <> 0"
    ),
    "pivot_drops_identifiers": _over_events(
        "SELECT event_timestamp, user_pseudo_id, user_id, page_location, "
        f"'{FIELD_NAMES}' AS field_names FROM e WHERE event_name = 'purchase'"
    ),
    "extra_columns": _over_events(
        "SELECT event_timestamp, event_name, 'WEB' AS platform, amount AS event_value_in_usd, "
        "medium AS traffic_medium FROM e WHERE event_name = 'purchase' AND filled"
    ),
    "event_session_id": _over_events(
        f"SELECT event_timestamp, {SESSION_ID} FROM e WHERE filled"
    ),
    "event_date": _over_events("SELECT event_timestamp, event_date FROM e WHERE filled"),
    "flatten_events_standard": _purchases(""),
    "flatten_events_unique": _purchases(""),
    "flatten_events_pinned_keys": _over_events(
        f"SELECT event_timestamp, {SESSION_ID}, CAST(value AS VARCHAR) AS value, page_location, "
        "CAST(NULL AS VARCHAR) AS absent FROM e WHERE filled"
    ),
    "flatten_events_ecommerce": _purchases("AND item_count > 0"),
    "items_drop_empty": _over_events("SELECT event_id, item_count FROM e WHERE item_count > 0"),
    "items_recollect": ITEMS_BY_DAY,
    "items_recollect_parts": ITEMS_BY_DAY,
    "traffic_defaults": "SELECT event_id, '' AS gclid, '' AS manual_source, '' AS partner FROM events",
    "session_eligible": _over_events(
        "SELECT event_id, user_pseudo_id, ga_session_id FROM e "
        "WHERE user_pseudo_id IS NOT NULL AND ga_session_id IS NOT NULL"
    ),
    "session_ordering": _over_events(
        "SELECT event_id, coalesce(custom_timestamp, event_timestamp // 1000) AS ordering_timestamp, "
        "event_date AS session_date FROM e "
        "WHERE user_pseudo_id IS NOT NULL AND ga_session_id IS NOT NULL"
    ),
    "session_bounds": _sessions("session_start_timestamp, session_end_timestamp"),
    "session_pages": _sessions("session_landing_page, session_exit_page, session_referrer_page"),
    "session_traffic_first_nonnull": _sessions(
        "medium, name, source, manual_source, gclid, '' AS site_name"
    ),
    "session_device_geo": _sessions(
        "category, operating_system, browser, continent, country, region"
    ),
    "session_identity": _sessions("ga_session_id, ga_session_number, user_pseudo_id, user_id"),
    "session_engaged": _sessions("is_engaged_session"),
    "flatten_sessions": _sessions(ALL_SESSION_COLUMNS.format(gclid="gclid")),
    "flatten_sessions_defaults": _sessions(ALL_SESSION_COLUMNS.format(gclid="''")),
    "param_float_text": _over_events(
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(k AS DOUBLE) / 4 AS VARCHAR) END "
        "AS rate FROM e WHERE filled"
    ),
    "pivot_first_set_value": _over_events(
        "SELECT event_id, CAST(k AS VARCHAR) AS twice FROM e WHERE filled"
    ),
    "pivot_wide": _over_events("""
        SELECT event_id, string_agg('w' || lpad(CAST(n AS VARCHAR), 2, '0') || (event_id % 7), ','
                                    ORDER BY n) AS wide
        FROM e JOIN range(100) AS numbers(n) ON (event_id + n) % 10 = 0
        WHERE filled GROUP BY event_id"""),
    "batch_columns_present": """
        SELECT event_id, event_id % 4 AS batch_event_index,
               CASE WHEN event_id % 3 <> 0 THEN event_id % 5 END AS batch_page_id,
               event_id % 6 AS batch_ordering_id
        FROM events""",
    "flatten_events_no_match": _over_events(
        "SELECT count(*) AS n, 'user_pseudo_id,user_id,session_id,event_name,event_date,"
        "event_timestamp,batch_event_index,geo,device,items,user_properties,event_params' AS names "
        "FROM e WHERE event_name = 'nothing'"
    ),
    "flatten_events_width": _purchases(""),
    "session_ordering_own_clock": f"""WITH {AWKWARD_SESSIONS}
        SELECT session_id, session_date, session_start_timestamp, session_end_timestamp,
               session_landing_page, session_exit_page FROM r""",
    "session_last_click": f"""WITH {AWKWARD_SESSIONS}
        SELECT DISTINCT session_id, event_date AS session_date, ga_session_id, user_pseudo_id,
               first_value(CASE WHEN event_id % 4 <> 0 THEN 'lc' || (event_id % 6) END IGNORE NULLS)
                 OVER (PARTITION BY session_id ORDER BY ordering_timestamp, event_timestamp
                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS source
        FROM s""",
    "run_job_empty": _over_events(
        "SELECT count(*) > 0 AS written, count(*) AS rows_written FROM e WHERE event_name = 'nothing'"
    ),
    "source_flat": _summary("true"),
    "source_dated": _summary("true"),
    "source_orc": _summary("true"),
    "source_json_schema": _summary("true"),
    "source_partition_filter": _summary("event_name = 'view'"),
    "source_table": _summary("true"),
    "source_query": _summary("event_name = 'view'"),
    "sink_partitioned": _over_events(_marks("'first'")),
    "sink_orc": _over_events(_marks("'first'")),
    "sink_day_overwrite": _over_events(_marks(SECOND_ON_DAY)),
    "sink_table_replace": _over_events(_marks("'second'")),
    "sink_table_day": _over_events(_marks(SECOND_ON_DAY)),
    "sink_append": _over_events(_marks("'first'") + " UNION ALL " + _marks("'second'")),
    "sink_schema_merge": _over_events(
        "SELECT event_timestamp, event_name, page_location, CAST(value AS VARCHAR) AS value "
        "FROM e WHERE event_name IN ('click', 'purchase') AND filled"
    ),
    "sink_table_append_new_key": _over_events(
        "SELECT event_timestamp, event_name, page_location, CAST(value AS VARCHAR) AS value "
        "FROM e WHERE event_name IN ('click', 'purchase') AND filled"
    ),
    "sink_table_day_other_keys": _over_events(f"""
        SELECT event_timestamp, event_name, event_date, page_location,
               CASE WHEN event_date <> '{DAY}' THEN page_referrer END AS page_referrer,
               CASE WHEN event_date = '{DAY}' THEN CAST(value AS VARCHAR) END AS value,
               {SECOND_ON_DAY} AS mark, CASE WHEN event_date = '{DAY}' THEN 'WEB' END AS platform
        FROM e WHERE filled"""),
    "sink_clustered": _over_events(
        "SELECT event_date, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_overlaps, "
        "count(*) >= 150 AS half_skipped FROM e WHERE filled GROUP BY event_date"
    ),
    "run_job_key_index": _over_events(f"""
        SELECT CAST(run AS BIGINT) AS run, count(*) AS rows_written,
               CASE WHEN run = 0 THEN replace('{FIELD_NAMES}', ',value', '') ELSE '{FIELD_NAMES}' END AS keys
        FROM e JOIN range(2) AS runs(run) ON event_name = 'click' OR (run = 1 AND event_name = 'purchase')
        WHERE filled GROUP BY run"""),
    "run_job_events": _purchases("AND item_count > 0"),
    "run_job_sessions": _sessions(ALL_SESSION_COLUMNS.format(gclid="''")),
    "run_job_counts": _over_events(
        "SELECT count(*) AS rows_read, "
        "count(*) FILTER (WHERE event_name = 'purchase' AND filled) AS rows_written FROM e"
    ),
}
