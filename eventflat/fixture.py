"""Nested export events derived from the flat ``events`` test table.

Times of the flat table have no zone and are read as UTC, whatever the session's zone. The
three batch columns and the two optional traffic-source columns are left out on purpose:
they exercise the defaults. The awkward variant has them, and parameters that are easy to
get wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.fields import COLLECTED_TRAFFIC_SOURCE

NO_SLOTS = {
    "string_value": "cast(null as string)",
    "int_value": "cast(null as bigint)",
    "float_value": "cast(null as double)",
    "double_value": "cast(null as double)",
}

# key, typed slot, condition for its presence, value
PARAMETERS = [
    ("page_location", "string_value", "event_id % 11 <> 0",
     "concat('https://shop.example/', event_type, '/', k % 10)"),
    ("page_referrer", "string_value", "k % 3 = 0", "concat('https://ref.example/', k % 7)"),
    ("ga_session_id", "int_value", "event_id % 37 <> 0", "sid"),
    ("ga_session_number", "int_value", "event_id % 37 <> 0", "sid - 19722"),
    ("session_engaged", "string_value", "true", "if(k >= 50, '1', '0')"),
    ("engagement_time_msec", "int_value", "true", "k * 100"),
    ("value", "double_value", "event_type = 'purchase'", "value"),
    ("custom_timestamp", "int_value", "event_id % 13 = 0", "us div 1000"),
    ("items", "string_value", "event_type = 'purchase'", "'[]'"),
]

COLUMNS = {
    "event_date": "replace(cast(cast(ts as date) as string), '-', '')",
    "event_timestamp": "us",
    "event_name": "event_type",
    "user_pseudo_id": "if(event_id % 50 = 0, null, concat('p', user_id))",
    "user_id": "if(event_id % 4 = 0, concat('u', user_id), null)",
    "device": """if(event_id % 9 = 0, null, named_struct(
        'category', element_at(array('desktop', 'mobile', 'tablet'), cast(user_id % 3 + 1 as int)),
        'operating_system', concat('os', event_id % 2),
        'web_info', named_struct('browser', concat('b', user_id % 4))))""",
    "geo": """named_struct(
        'continent', concat('K', user_id % 2), 'country', concat('C', user_id % 5),
        'region', concat('R', event_id % 3), 'city', cast(null as string))""",
    "items": """filter(transform(array(1, 2, 3), i -> named_struct(
        'item_id', concat('sku', (k + i) % 20), 'item_name', concat('item ', i),
        'price', i + 0.5D, 'quantity', cast(i as bigint))),
        x -> event_type = 'purchase' and x.quantity <= k % 4)""",
    "user_properties": """array(named_struct('key', 'plan', 'value', named_struct(
        'string_value', concat('plan', user_id % 2), 'int_value', cast(null as bigint),
        'float_value', cast(null as double), 'double_value', cast(null as double))))""",
    "traffic_source": """if(event_id % 7 = 0, null, named_struct(
        'medium', concat('m', k % 3), 'name', concat('n', k % 4), 'source', concat('s', k % 5)))""",
    "event_previous_timestamp": "cast(null as bigint)",
    "event_value_in_usd": "if(event_type = 'purchase', value, null)",
    "event_bundle_sequence_id": "event_id",
    "event_server_timestamp_offset": "cast(0 as bigint)",
    "stream_id": "'1'",
    "platform": "'WEB'",
    "event_dimensions": "named_struct('hostname', 'shop.example')",
}

MICROS = """datediff(cast(ts as date), date'1970-01-01') * 86400000000L + hour(ts) * 3600000000L
  + minute(ts) * 60000000L + cast(extract(second from ts) * 1000000 as bigint)"""

WIDE_KEYS = [f"w{number:02}" for number in range(100)]

# An own clock that contradicts the export's, a float, a key three times (without a value
# first in every third event).
AWKWARD_PARAMETERS = [
    *[entry for entry in PARAMETERS if entry[0] != "custom_timestamp"],
    ("custom_timestamp", "int_value", "event_id % 13 = 0",
     "us div 1000 + (event_id % 5 - 2) * 3600000"),
    ("rate", "float_value", "event_id % 2 = 0", "k / 4D"),
    ("twice", "string_value", "event_id % 3 = 0", "cast(null as string)"),
    ("twice", "int_value", "true", "k"),
    ("twice", "string_value", "true", "'late'"),
]

AWKWARD_COLUMNS = {
    **COLUMNS,
    "batch_event_index": "event_id % 4",
    "batch_page_id": "if(event_id % 3 = 0, null, event_id % 5)",
    "batch_ordering_id": "event_id % 6",
    "session_traffic_source_last_click": """if(event_id % 4 = 0, null, named_struct(
        'manual_campaign', named_struct('source', concat('lc', event_id % 6))))""",
}


def _entry(key: str, slot: str, value: str) -> str:
    slots = {**NO_SLOTS, slot: value}
    fields = ", ".join(f"'{name}', {text}" for name, text in slots.items())
    return f"named_struct('key', {key}, 'value', named_struct({fields}))"


def _parameter(key: str, slot: str, present: str, value: str) -> str:
    """An array of this parameter, or an empty one. No lambda: so it can be compiled."""
    entry = _entry(f"'{key}'", slot, value)
    return f"if({present}, array({entry}), array())"


def _wide_parameters() -> str:
    """Many keys of which an event has a tenth."""
    keys = ", ".join(f"'{key}'" for key in WIDE_KEYS)
    own = f"filter(array({keys}), (key, number) -> (event_id + number) % 10 = 0)"
    return f"transform({own}, key -> {_entry('key', 'string_value', 'concat(key, event_id % 7)')})"


def _collected_traffic_source() -> str:
    """For one event in three a struct of which two fields are filled."""
    filled = {"manual_source": "concat('cs', k % 4)", "gclid": "concat('g', event_id)"}
    fields = ", ".join(f"'{name}', {filled.get(name, repr(''))}" for name in COLLECTED_TRAFFIC_SOURCE)
    return f"if(event_id % 3 = 0, named_struct({fields}), null)"


def nested_events(
    events: DataFrame, collected: bool = False, awkward: bool = False
) -> DataFrame:
    """The ``events`` table in the nested export schema, row for row.

    ``collected`` adds the optional column ``collected_traffic_source``. Helper values and
    parameters come from a generator of one row: filters on them are not pushed below it, so
    each event's are made once, as if they had been read.
    """
    columns = dict(AWKWARD_COLUMNS if awkward else COLUMNS)
    if collected:
        columns["collected_traffic_source"] = _collected_traffic_source()
    helped = events.withColumns(
        {
            "k": F.expr("cast(get_json_object(props, '$.k') as bigint)"),
            "us": F.expr(MICROS),
        }
    ).withColumn("sid", F.expr("(us div 1000000 + 43200) div 86400"))
    parameters = AWKWARD_PARAMETERS if awkward else PARAMETERS
    entries = [_parameter(*parameter) for parameter in parameters]
    if awkward:
        helped = helped.withColumn("wide", F.expr(_wide_parameters()))
        entries.append("wide")
    params = f"if(event_id % 101 = 0, array(), concat({', '.join(entries)}))"
    made = f"named_struct('k', k, 'us', us, 'event_params', {params})"
    rows = helped.select(*events.columns, F.expr(f"inline(array({made}))"))
    return rows.select(
        *[F.expr(text).alias(name) for name, text in columns.items()], "event_params"
    )


def load_nested_events(
    spark: SparkSession, sf_dir: str, collected: bool = False, awkward: bool = False
) -> DataFrame:
    return nested_events(spark.read.parquet(f"{sf_dir}/events.parquet"), collected, awkward)
