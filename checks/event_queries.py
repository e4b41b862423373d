"""Queries over filters, parameters, items and whole flattened events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflat import flatten_events
from eventflat.fixture import WIDE_KEYS, load_nested_events
from eventflat.functions import param_lookup, value_text
from eventflat.operators import (
    discover_param_keys,
    distinct_param_keys,
    explode_params,
    keep_events,
    keep_events_with_items,
    pivot_params,
    with_batch_defaults,
)
from eventflat.operators.params import struct_keys

ALL_NAMES = ["click", "error", "purchase", "signup", "view"]
MICROS_PER_DAY = 86_400_000_000


def event_id() -> Column:
    return F.col("event_bundle_sequence_id").alias("event_id")


def _names_and_times(events: DataFrame) -> DataFrame:
    return events.select(event_id(), "event_name", "event_timestamp")


def filter_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names_and_times(keep_events(load_nested_events(spark, sf_dir), "purchase"))


def filter_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return _names_and_times(keep_events(nested, "click", ["purchase", "signup"], "v%"))


def filter_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return _names_and_times(keep_events(nested, "click", event_pattern="_i%"))


def default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_batch_defaults(load_nested_events(spark, sf_dir))
    return events.select(
        event_id(), "batch_event_index", "batch_page_id", "batch_ordering_id"
    )


def params_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return explode_params(nested, "event_bundle_sequence_id").select(
        event_id(), "key", "string_value", "int_value", "float_value", "double_value"
    )


def param_value_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    entries = nested.select(event_id(), F.explode("event_params").alias("entry"))
    return entries.select(
        "event_id",
        F.col("entry.key").alias("key"),
        F.expr(value_text("entry.value")).alias("value"),
    )


def param_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_param_keys(load_nested_events(spark, sf_dir))


def param_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_nested_events(spark, sf_dir).select(
        event_id(),
        param_lookup("page_location", "string_value").alias("page_location"),
        param_lookup("ga_session_id", "int_value").alias("ga_session_id"),
        param_lookup("value", "double_value").alias("value"),
        param_lookup("ga_session_id", "string_value").alias("session_as_string"),
    )


def pivot_params_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keep_events(load_nested_events(spark, sf_dir), event_list=ALL_NAMES)
    keys = struct_keys(discover_param_keys(events))
    pivoted = pivot_params(events, keys, ["event_bundle_sequence_id"], merge=False)
    return pivoted.select(event_id(), "event_params.*")


def pivot_merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event arrives three times, with every other parameter; the merge completes it."""
    nested = load_nested_events(spark, sf_dir)

    def part(rest: int) -> DataFrame:
        kept = F.filter("event_params", lambda _, place: place % 2 == rest)
        return nested.withColumn("event_params", kept)

    copies = part(0).unionByName(part(1)).unionByName(part(0))
    flat = flatten_events(copies, event_list=ALL_NAMES)
    return flat.select("event_timestamp", "event_name", "session_id", "event_params.*")


def _field_names(flat: DataFrame) -> Column:
    return F.lit(",".join(flat.schema["event_params"].dataType.fieldNames()))


def pivot_excludes_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with an even k keep only their ``items`` parameter, so they vanish."""
    nested = load_nested_events(spark, sf_dir)
    only_items = F.filter("event_params", lambda entry: entry["key"] == "items")
    even = param_lookup("engagement_time_msec", "int_value") % 200 == 0
    changed = nested.withColumn(
        "event_params", F.when(even, only_items).otherwise(F.col("event_params"))
    )
    flat = flatten_events(changed, "purchase")
    return flat.select("event_timestamp", _field_names(flat).alias("field_names"))


def pivot_drops_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event also carries both identifiers as parameters."""
    nested = load_nested_events(spark, sf_dir)
    entry = nested.schema["event_params"].dataType.elementType
    identifiers = F.array(
        *[
            F.struct(
                F.lit(key).alias("key"),
                F.struct(
                    F.lit("x").alias("string_value"),
                    F.lit(None).cast("long").alias("int_value"),
                    F.lit(None).cast("double").alias("float_value"),
                    F.lit(None).cast("double").alias("double_value"),
                ).alias("value"),
            ).cast(entry)
            for key in ("user_id", "user_pseudo_id")
        ]
    )
    changed = nested.withColumn("event_params", F.concat("event_params", identifiers))
    flat = flatten_events(changed, "purchase")
    return flat.select(
        "event_timestamp",
        "user_pseudo_id",
        "user_id",
        "event_params.page_location",
        _field_names(flat).alias("field_names"),
    )


def extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    extras = ["platform", "event_value_in_usd", "traffic_source", "event_name"]
    flat = flatten_events(nested, "purchase", additional_columns_to_select=extras)
    return flat.select(
        "event_timestamp",
        "event_name",
        "platform",
        "event_value_in_usd",
        F.col("traffic_source.medium").alias("traffic_medium"),
    )


def event_session_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_events(load_nested_events(spark, sf_dir), event_list=ALL_NAMES)
    return flat.select("event_timestamp", "session_id")


def event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_events(load_nested_events(spark, sf_dir), event_pattern="%")
    return flat.select("event_timestamp", F.col("event_date").cast("string").alias("event_date"))


def flat_scalars(flat: DataFrame) -> DataFrame:
    """Flattened purchases as plain columns."""
    return flat.select(
        "user_pseudo_id",
        "user_id",
        "session_id",
        "event_name",
        F.col("event_date").cast("string").alias("event_date"),
        "event_timestamp",
        "batch_event_index",
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        F.col("device.web_info.browser").alias("browser"),
        F.size("items").cast("long").alias("item_count"),
        F.array_join(F.array_sort("items.item_id"), ",").alias("item_ids"),
        F.col("user_properties")[0]["value"]["string_value"].alias("plan"),
        "event_params.*",
    )


def flatten_events_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_scalars(flatten_events(load_nested_events(spark, sf_dir), "purchase"))


def flatten_events_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return flat_scalars(flatten_events(nested, "purchase", assume_unique=True))


def flatten_events_pinned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    flat = flatten_events(
        nested, event_list=ALL_NAMES, param_keys=["value", "page_location", "absent"]
    )
    return flat.select("event_timestamp", "session_id", "event_params.*")


def flatten_events_ecommerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return flat_scalars(flatten_events(nested, "purchase", "ecommerce"))


def items_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keep_events_with_items(load_nested_events(spark, sf_dir))
    return events.select(event_id(), F.size("items").cast("long").alias("item_count"))


def items_recollect(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Timestamps cut to the day, so that the purchases of a session's day share a row."""
    nested = load_nested_events(spark, sf_dir).withColumns(
        {
            "event_timestamp": F.expr(f"event_timestamp div {MICROS_PER_DAY} * {MICROS_PER_DAY}"),
            "batch_event_index": F.col("event_bundle_sequence_id"),
        }
    )
    flat = flatten_events(nested, "purchase", "ecommerce", **options)
    return flat.select(
        "user_pseudo_id",
        "session_id",
        "event_timestamp",
        F.size("items").cast("long").alias("item_count"),
        F.array_join(F.array_sort("items.item_id"), ",").alias("item_ids"),
    )


def items_recollect_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each row's items gathered in parts first."""
    return items_recollect(spark, sf_dir, item_parts=8)


def _awkward_fields(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    events = load_nested_events(spark, sf_dir, awkward=True)
    pivoted = pivot_params(events, keys, ["event_bundle_sequence_id"], merge=False)
    return pivoted.select(event_id(), "event_params.*")


def param_float_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _awkward_fields(spark, sf_dir, "rate")


def pivot_first_set_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that comes up to three times, the first time without a value."""
    return _awkward_fields(spark, sf_dir, "twice")


def pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred found keys among others, of which an event has a tenth."""
    flat = flatten_events(
        load_nested_events(spark, sf_dir, awkward=True),
        event_list=ALL_NAMES,
        additional_columns_to_select=["event_bundle_sequence_id"],
    )
    wide = [F.col(f"event_params.{key}") for key in WIDE_KEYS]
    return flat.select(event_id(), F.concat_ws(",", *wide).alias("wide"))


def batch_columns_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_batch_defaults(load_nested_events(spark, sf_dir, awkward=True))
    return events.select(event_id(), "batch_event_index", "batch_page_id", "batch_ordering_id")


def flatten_events_no_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No event of that name: no row, in the flattened schema."""
    flat = flatten_events(load_nested_events(spark, sf_dir), "nothing")
    names = F.lit(",".join(flat.columns)).alias("names")
    return flat.agg(F.count(F.lit(1)).alias("n")).select("n", names)


def flatten_events_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load_nested_events(spark, sf_dir)
    return flat_scalars(flatten_events(nested, "purchase", num_partitions=5))


QUERIES = {
    "filter_name": filter_name,
    "filter_list": filter_list,
    "filter_pattern": filter_pattern,
    "default_columns": default_columns,
    "params_long": params_long,
    "param_value_text": param_value_text,
    "param_keys": param_keys,
    "param_lookup": param_lookup_query,
    "pivot_params": pivot_params_query,
    "pivot_merge_duplicates": pivot_merge_duplicates,
    "pivot_excludes_items": pivot_excludes_items,
    "pivot_drops_identifiers": pivot_drops_identifiers,
    "extra_columns": extra_columns,
    "event_session_id": event_session_id,
    "event_date": event_date,
    "flatten_events_standard": flatten_events_standard,
    "flatten_events_unique": flatten_events_unique,
    "flatten_events_pinned_keys": flatten_events_pinned_keys,
    "flatten_events_ecommerce": flatten_events_ecommerce,
    "items_drop_empty": items_drop_empty,
    "items_recollect": items_recollect,
    "items_recollect_parts": items_recollect_parts,
    "param_float_text": param_float_text,
    "pivot_first_set_value": pivot_first_set_value,
    "pivot_wide": pivot_wide,
    "batch_columns_present": batch_columns_present,
    "flatten_events_no_match": flatten_events_no_match,
    "flatten_events_width": flatten_events_width,
}
