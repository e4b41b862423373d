"""Queries over session steps and whole session rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflat import flatten_sessions
from eventflat.fixture import load_nested_events
from eventflat.operators import events_in_sessions, with_session_params, with_traffic_defaults


def event_id() -> Column:
    return F.col("event_bundle_sequence_id").alias("event_id")


def row_key() -> tuple[Column, Column]:
    return F.col("session_id"), F.col("session_date").cast("string").alias("session_date")


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_sessions(load_nested_events(spark, sf_dir, collected=True))


def traffic_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_traffic_defaults(load_nested_events(spark, sf_dir))
    return events.select(
        event_id(),
        F.col("collected_traffic_source.gclid").alias("gclid"),
        F.col("session_traffic_source_last_click.manual_campaign.source").alias("manual_source"),
        F.col("session_traffic_source_last_click.dv360_campaign.partner_name").alias("partner"),
    )


def session_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_in_sessions(load_nested_events(spark, sf_dir))
    return events.select(event_id(), "user_pseudo_id", "ga_session_id")


def session_ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_session_params(events_in_sessions(load_nested_events(spark, sf_dir)))
    return events.select(
        event_id(), "ordering_timestamp", F.col("session_date").cast("string").alias("session_date")
    )


def session_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(
        *row_key(), "session_start_timestamp", "session_end_timestamp"
    )


def session_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(
        *row_key(), "session_landing_page", "session_exit_page", "session_referrer_page"
    )


def session_traffic_first_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(
        *row_key(),
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.name").alias("name"),
        F.col("traffic_source.source").alias("source"),
        F.col("collected_traffic_source.manual_source").alias("manual_source"),
        F.col("collected_traffic_source.gclid").alias("gclid"),
        F.col("session_traffic_source_last_click.cm360_campaign.site_name").alias("site_name"),
    )


def session_device_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(
        *row_key(),
        F.col("device.category").alias("category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("geo.continent").alias("continent"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
    )


def session_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(
        *row_key(), "ga_session_id", "ga_session_number", "user_pseudo_id", "user_id"
    )


def session_engaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select(*row_key(), "is_engaged_session")


def session_scalars(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        *row_key(),
        "session_start_timestamp",
        "session_end_timestamp",
        "ga_session_id",
        "ga_session_number",
        "user_pseudo_id",
        "user_id",
        "session_landing_page",
        "session_exit_page",
        "session_referrer_page",
        F.col("session_traffic_source_last_click.manual_campaign.term").alias("term"),
        F.col("collected_traffic_source.gclid").alias("gclid"),
        F.col("traffic_source.medium").alias("medium"),
        F.col("device.category").alias("category"),
        F.col("geo.region").alias("region"),
        "is_engaged_session",
    )


def flatten_sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_scalars(_sessions(spark, sf_dir))


def flatten_sessions_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_scalars(flatten_sessions(load_nested_events(spark, sf_dir)))


def session_ordering_own_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose own clock contradicts the export's."""
    sessions = flatten_sessions(load_nested_events(spark, sf_dir, awkward=True))
    return sessions.select(
        *row_key(),
        "session_start_timestamp",
        "session_end_timestamp",
        "session_landing_page",
        "session_exit_page",
    )


def session_last_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = flatten_sessions(load_nested_events(spark, sf_dir, awkward=True))
    source = F.col("session_traffic_source_last_click.manual_campaign.source")
    return sessions.select(*row_key(), "ga_session_id", "user_pseudo_id", source.alias("source"))


QUERIES = {
    "traffic_defaults": traffic_defaults,
    "session_eligible": session_eligible,
    "session_ordering": session_ordering,
    "session_bounds": session_bounds,
    "session_pages": session_pages,
    "session_traffic_first_nonnull": session_traffic_first_nonnull,
    "session_device_geo": session_device_geo,
    "session_identity": session_identity,
    "session_engaged": session_engaged,
    "session_ordering_own_clock": session_ordering_own_clock,
    "session_last_click": session_last_click,
    "flatten_sessions": flatten_sessions_query,
    "flatten_sessions_defaults": flatten_sessions_defaults,
}
