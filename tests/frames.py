"""Small nested event frames written row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SLOTS = "string_value string, int_value bigint, float_value double, double_value double"
PARAMS = f"array<struct<key: string, value: struct<{SLOTS.replace(' ', ': ').replace(',: ', ', ')}>>>"
DEVICE = "struct<category: string, operating_system: string>"
ITEMS = "array<struct<item_id: string, price: double>>"

SCHEMA = f"""event_date string, event_timestamp bigint, event_name string,
  event_params {PARAMS}, user_pseudo_id string, user_id string, device {DEVICE},
  geo struct<country: string>, items {ITEMS}, user_properties {PARAMS},
  traffic_source struct<medium: string, name: string, source: string>"""

DEFAULTS = {
    "event_date": "20240101",
    "event_timestamp": 1_704_100_000_000_000,
    "event_name": "view",
    "event_params": [],
    "user_pseudo_id": "p1",
    "user_id": None,
    "device": ("desktop", "os"),
    "geo": ("DE",),
    "items": [],
    "user_properties": [],
    "traffic_source": None,
}


class Slots(tuple):
    """A value given slot by slot: string, int, float, double."""


def value(content) -> tuple | None:
    if content is None or isinstance(content, Slots):
        return content
    if isinstance(content, str):
        return (content, None, None, None)
    if isinstance(content, int):
        return (None, content, None, None)
    return (None, None, None, content)


def params(*entries) -> list:
    """``("key", content)`` pairs as an array of typed entries."""
    return [(key, value(content)) for key, content in entries]


def frame(spark: SparkSession, *rows: dict, schema: str = SCHEMA) -> DataFrame:
    filled = [{**DEFAULTS, **row} for row in rows]
    names = list(DEFAULTS)
    extra = [name for name in (rows[0] if rows else {}) if name not in names]
    return spark.createDataFrame(
        [tuple(row[name] for name in [*names, *extra]) for row in filled], schema
    )


def exchanges(data: DataFrame) -> int:
    return plan(data).count("Exchange ")


def plan(data: DataFrame) -> str:
    return data._jdf.queryExecution().executedPlan().toString()
