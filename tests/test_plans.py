"""What Spark makes of the jobs: shuffles, pushed filters, columns read."""

from __future__ import annotations

import re

import pytest
from frames import exchanges, plan

from eventflat import flatten_events, flatten_sessions
from eventflat.fixture import load_nested_events
from eventflat.operators import distinct_param_keys, keep_events

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "nested")
    load_nested_events(spark, FOLDER, collected=True).write.parquet(path)
    return spark.read.parquet(path)


def read_schema(data) -> str:
    """Columns a plan reads, in full."""
    text = data._jdf.queryExecution().toString()
    relations = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    return relations[-1]


def test_unique_events_need_no_shuffle(stored):
    flat = flatten_events(stored, "purchase", assume_unique=True)
    assert exchanges(flat) == 0
    assert "Generate" not in plan(flat)


def test_merge_is_one_shuffle_with_a_partial_aggregate(stored):
    flat = flatten_events(stored, "purchase")
    assert exchanges(flat) == 1
    assert "Generate" not in plan(flat)
    assert "partial_min_by" in plan(flat)


def test_items_add_one_shuffle_and_are_filtered_in_the_scan_stage(stored):
    flat = flatten_events(stored, "purchase", "ecommerce")
    assert exchanges(flat) == 2
    below = plan(flat).split("Exchange")[-1]
    assert "size(items" in below


def test_pinned_keys_run_no_job(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "planning only")
    flatten_events(stored, "purchase", "ecommerce", param_keys=["value"])
    flatten_sessions(stored)
    assert list(tracker.getJobIdsForGroup("lazy")) == []


def test_events_with_keys_are_found_without_a_lambda(stored):
    flat = plan(flatten_events(stored, "purchase", param_keys=["value"]))
    assert "exists(" not in flat and "array_remove(event_params" in flat


def test_event_filters_reach_the_scan(stored):
    name = plan(flatten_events(stored, "purchase", param_keys=["value"]))
    assert "EqualTo(event_name,purchase)" in name
    several = plan(flatten_events(stored, event_list=["click", "view"], param_keys=["value"]))
    assert "In(event_name, [click,view])" in several
    prefix = plan(flatten_events(stored, event_pattern="pur%", param_keys=["value"]))
    assert "StringStartsWith(event_name,pur)" in prefix


def test_key_discovery_reads_names_and_keys_only(stored):
    text = plan(distinct_param_keys(keep_events(stored, "purchase")))
    assert "ReadSchema: struct<event_name:string,event_params:array<struct<key:string>>>" in text


def test_flattening_reads_no_unused_column(stored):
    columns = read_schema(flatten_events(stored, "purchase", param_keys=["value"]))
    for unused in ("stream_id", "traffic_source", "event_dimensions", "platform"):
        assert unused not in columns


def test_sessions_reduce_before_the_shuffle(stored):
    sessions = flatten_sessions(stored)
    assert exchanges(sessions) == 1
    assert "Window" not in plan(sessions)
    below = plan(sessions).split("Exchange")[-1]
    for function in ("partial_min_by", "partial_max_by", "partial_collect_set"):
        assert function in below
    assert "Generate" not in below


def test_sessions_read_only_the_slots_they_use(stored):
    session = stored.sparkSession
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan(flatten_sessions(stored))
    finally:
        session.conf.unset("spark.sql.maxMetadataStringLength")
    assert (
        "event_params:array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>"
        in text
    )
    assert "items" not in text


def test_absent_traffic_columns_stay_out_of_the_shuffle(stored):
    text = plan(flatten_sessions(stored.drop("collected_traffic_source")))
    assert "srsltid" not in text.split("Exchange", 1)[1]


def test_optional_width(stored):
    flat = flatten_events(stored, "purchase", assume_unique=True, num_partitions=5)
    assert flat.rdd.getNumPartitions() == 5
