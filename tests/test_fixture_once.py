"""Nested test events: the rows of the plain form, each event's parameters made once."""

from __future__ import annotations

import pytest
from frames import plan
from pyspark.sql import functions as F

from eventflat.fixture import AWKWARD_PARAMETERS, PARAMETERS, WIDE_KEYS, nested_events
from eventflat.operators import distinct_param_keys, pivot_params

WIDE = [
    (key, "string_value", f"(event_id + {number}) % 10 = 0", f"concat('{key}', event_id % 7)")
    for number, key in enumerate(WIDE_KEYS)
]
SLOTS = {"string_value": "string", "int_value": "bigint", "float_value": "double", "double_value": "double"}


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (number, f"2024-01-{1 + (number or 0) % 28:02} 10:00:01.5", number and number * 3, name, 2.5, props)
        for number in (None, -7, 0, 1, 13, 101, 130, 429)
        for name in ("purchase", "view", None)
        for props in ('{"k": 3}', '{"k": 52}', "{}", None)
    ]
    flat = spark.createDataFrame(
        rows, "event_id long, ts string, user_id long, event_type string, value double, props string"
    )
    return flat.withColumn("ts", F.expr("cast(ts as timestamp_ntz)"))


def plain_params(events, parameters):
    """All parameters tried, those not present filtered out."""

    def entry(key, slot, present, value):
        slots = ", ".join(
            f"'{name}', cast({value if name == slot else 'null'} as {kind})" for name, kind in SLOTS.items()
        )
        return f"if({present}, named_struct('key', '{key}', 'value', named_struct({slots})), null)"

    helped = events.withColumn("k", F.expr("cast(get_json_object(props, '$.k') as bigint)"))
    helped = helped.withColumn("us", F.expr("unix_micros(cast(ts as timestamp))"))
    helped = helped.withColumn("sid", F.expr("(us div 1000000 + 43200) div 86400"))
    listed = ", ".join(entry(*parameter) for parameter in parameters)
    made = f"if(event_id % 101 = 0, array(), filter(array({listed}), p -> p is not null))"
    return helped.select("event_id", F.expr(made).alias("event_params"))


@pytest.mark.parametrize("awkward", [False, True])
def test_parameters_are_those_of_the_plain_form(events, awkward):
    parameters = [*AWKWARD_PARAMETERS, *WIDE] if awkward else PARAMETERS
    found = nested_events(events, awkward=awkward)
    found = found.select(F.col("event_bundle_sequence_id").alias("event_id"), "event_params")
    wanted = plain_params(events, parameters)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


@pytest.mark.parametrize("awkward", [False, True])
def test_helper_values_are_made_once(events, awkward):
    nested = nested_events(events, awkward=awkward)
    pivoted = pivot_params(nested, ["value"], ["event_name"], merge=False)
    assert plan(pivoted).count("get_json_object") == 1
    assert plan(distinct_param_keys(nested)).count("get_json_object") == 1


def test_a_filter_on_names_goes_below_the_generator(events, spark, tmp_path):
    events.write.parquet(str(tmp_path / "events"))
    nested = nested_events(spark.read.parquet(str(tmp_path / "events")))
    assert "EqualTo(event_type,view)" in plan(nested.where("event_name = 'view'"))
