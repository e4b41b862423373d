"""Hand-made rows for event flattening (X-1 to X-13 of FIXTURES.md)."""

from __future__ import annotations

import pytest
from frames import PARAMS, SCHEMA, Slots, frame, params
from pyspark.sql import types as T

from eventflat import flatten_events
from eventflat.plans.events import EVENT_COLUMNS

SESSION = ("ga_session_id", 7)


def structs(flat) -> list[dict]:
    return [row["event_params"].asDict() for row in flat.collect()]


def test_x1_no_params_no_row(spark):
    events = frame(spark, {"event_params": None}, {"event_params": []})
    assert flatten_events(events, "view").collect() == []


def test_x2_only_items_or_null_key_no_row(spark):
    events = frame(
        spark,
        {"event_params": params(("items", "[]"))},
        {"event_params": params((None, "x"))},
        {"event_params": params((None, "x"), ("items", "[]"))},
    )
    flat = flatten_events(events, "view")
    assert flat.collect() == []
    assert flat.columns == list(EVENT_COLUMNS)


def test_x3_only_identifiers_keep_row_without_fields(spark):
    events = frame(spark, {"event_params": params(("user_pseudo_id", "x"), ("user_id", "y"))})
    flat = flatten_events(events, "view")
    assert len(flat.collect()) == 1
    assert flat.schema["event_params"].dataType == T.StructType([])


def test_x4_first_value_that_is_set(spark):
    empty = Slots((None, None, None, None))
    events = frame(
        spark,
        {"event_params": params(("a", empty), ("a", "x"), ("a", "y"))},
        {"event_timestamp": 2, "event_params": params(("a", None), ("a", "z"))},
        {"event_timestamp": 3, "event_params": params(("a", empty), ("b", 1))},
    )
    flat = flatten_events(events, "view").orderBy("event_timestamp")
    assert [row["event_params"]["a"] for row in flat.collect()] == ["z", None, "x"]


def test_x5_equal_events_merge(spark):
    events = frame(
        spark,
        {"event_params": params(("a", "1"))},
        {"event_params": params(("b", "2"))},
        {"event_params": params(("b", "2"))},
    )
    assert structs(flatten_events(events, "view")) == [{"a": "1", "b": "2"}]
    assert len(flatten_events(events, "view", assume_unique=True).collect()) == 3


def test_x5_merge_prefers_one_event(spark):
    events = frame(
        spark,
        {"event_params": params(("a", "1"), ("b", "2"))},
        {"event_params": params(("a", "2"), ("b", "1"), ("c", "3"))},
    )
    (found,) = structs(flatten_events(events, "view"))
    assert (found["a"], found["b"]) in {("1", "2"), ("2", "1")}
    assert found["c"] == "3"
    (again,) = structs(flatten_events(events.repartition(5), "view"))
    assert again == found


def test_x5_null_identity_columns_are_equal(spark):
    row = {"user_pseudo_id": None, "device": None, "geo": None, "items": None}
    events = frame(
        spark,
        {**row, "event_params": params(("a", "1"))},
        {**row, "event_params": params(("b", "2"))},
    )
    assert structs(flatten_events(events, "view")) == [{"a": "1", "b": "2"}]


def test_x6_awkward_keys(spark):
    keys = [
        "a.b", "event_date", "geo", "it's", "key",
        "say \"hi\"", "`tick`", "items_", "a\\b\\\\", "line\n", "ü", "x\\'",
    ]
    events = frame(spark, {"event_params": params(*[(key, key) for key in keys])})
    assert structs(flatten_events(events, "view")) == [{key: key for key in sorted(keys)}]


def test_x7_case_clash(spark):
    events = frame(spark, {"event_params": params(("Foo", "1"), ("foo", "2"), ("bar", "3"))})
    with pytest.raises(ValueError, match=r"Foo.*foo"):
        flatten_events(events, "view")


def test_x8_slots(spark):
    events = frame(
        spark,
        {
            "event_params": params(
                ("f", Slots((None, None, 1.5, None))),
                ("d", 2.5),
                ("i", 12),
                ("both", Slots(("text", 3, None, None))),
                ("numbers", Slots((None, 3, 4.5, 5.5))),
            )
        },
    )
    assert structs(flatten_events(events, "view")) == [
        {"both": "text", "d": "2.5", "f": "1.5", "i": "12", "numbers": "3"}
    ]


def test_x9_no_session_parameter(spark):
    events = frame(spark, {"event_params": params(("a", "1"))})
    (row,) = flatten_events(events, "view").collect()
    assert row["session_id"] is None


def test_session_id_needs_no_pinned_session_key(spark):
    events = frame(spark, {"event_params": params(("a", "1"), SESSION)})
    (row,) = flatten_events(events, "view", param_keys=["a"]).collect()
    assert row["session_id"] == "p17"
    assert row["event_params"].asDict() == {"a": "1"}


def test_session_id_null_without_user(spark):
    events = frame(spark, {"user_pseudo_id": None, "event_params": params(SESSION)})
    (row,) = flatten_events(events, "view").collect()
    assert row["session_id"] is None


def test_x10_precedence_and_no_match(spark):
    events = frame(
        spark,
        *[
            {"event_name": name, "event_params": params(("a", name))}
            for name in ("one", "two", "three", None)
        ],
    )

    def names(**filters):
        return sorted(row["event_name"] for row in flatten_events(events, **filters).collect())

    assert names(event_name="one", event_list=["two"], event_pattern="th%") == ["two"]
    assert names(event_name="one", event_list=[], event_pattern="th%") == ["three"]
    assert names(event_name="one") == ["one"]
    assert names(event_pattern="%") == ["one", "three", "two"]
    empty = flatten_events(events, "absent")
    assert empty.collect() == []
    assert empty.columns == list(EVENT_COLUMNS)
    with pytest.raises(ValueError, match="event_name"):
        flatten_events(events)


def test_x11_like(spark):
    names = ("view_item", "viewXitem", "VIEW_ITEM")
    events = frame(
        spark, *[{"event_name": name, "event_params": params(("a", "1"))} for name in names]
    )
    found = flatten_events(events, event_pattern="view_%").collect()
    assert sorted(row["event_name"] for row in found) == ["viewXitem", "view_item"]


def test_x12_items_missing(spark):
    rows = [None, [], [None], [("sku", 1.0), None]]
    events = frame(
        spark,
        *[
            {"event_timestamp": place, "items": items, "event_params": params(SESSION)}
            for place, items in enumerate(rows)
        ],
    )
    flat = flatten_events(events, "view", "ecommerce").orderBy("event_timestamp")
    found = [[item["item_id"] for item in row["items"]] for row in flat.collect()]
    assert found == [[], ["sku"]]


@pytest.mark.parametrize("session", [SESSION, ("a", "no session")])
def test_x13_items_of_one_moment_unite(spark, session):
    events = frame(
        spark,
        {"user_id": "u1", "items": [("1", 1.0), ("2", 1.0)], "event_params": params(session)},
        {"user_id": "u2", "items": [("3", 1.0)], "event_params": params(session)},
        {"user_id": "u3", "items": [], "event_params": params(session)},
    )
    (row,) = flatten_events(events, "view", "ecommerce").collect()
    assert sorted(item["item_id"] for item in row["items"]) == ["1", "2", "3"]
    assert row["user_id"] in {"u1", "u2"}
    (again,) = flatten_events(events.repartition(4), "view", "ecommerce").collect()
    assert again == row


def test_items_repeats_stay_and_follow_event_order(spark):
    events = frame(
        spark,
        {"event_name": "b", "items": [("2", 1.0), ("1", 1.0)], "event_params": params(SESSION)},
        {"event_name": "a", "items": [("1", 1.0)], "event_params": params(SESSION)},
    )
    (row,) = flatten_events(events, event_list=["a", "b"], event_type="ecommerce").collect()
    assert [item["item_id"] for item in row["items"]] == ["1", "2", "1"]
    assert row["event_name"] == "a"


def test_other_event_types_keep_events_without_items(spark):
    events = frame(spark, {"items": None, "event_params": params(SESSION)})
    assert flatten_events(events, "view", "Ecommerce").count() == 1


def test_x22_malformed_date_raises_and_null_stays(spark):
    good = frame(spark, {"event_date": None, "event_params": params(SESSION)})
    (row,) = flatten_events(good, "view").collect()
    assert row["event_date"] is None
    bad = frame(spark, {"event_date": "2024-x", "event_params": params(SESSION)})
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
        flatten_events(bad, "view").collect()


def test_extras_are_identity_and_repeats_are_ignored(spark):
    schema = SCHEMA + ", platform string"
    events = frame(
        spark,
        {"platform": "WEB", "event_params": params(("a", "1"))},
        {"platform": "IOS", "event_params": params(("a", "1"))},
        schema=schema,
    )
    extras = ["platform", "geo", "platform", "batch_page_id"]
    flat = flatten_events(events, "view", additional_columns_to_select=extras)
    assert flat.columns == [*EVENT_COLUMNS, "platform", "batch_page_id"]
    assert flat.count() == 2


def test_batch_columns_tell_events_apart(spark):
    schema = SCHEMA + ", batch_event_index bigint"
    rows = [
        {"batch_event_index": index, "event_params": params(("a", "1"))} for index in (1, 2, None)
    ]
    flat = flatten_events(frame(spark, *rows, schema=schema), "view")
    assert {row["batch_event_index"] for row in flat.collect()} == {1, 2, None}


def test_too_many_keys(spark):
    events = frame(spark, {"event_params": params(("a", "1"), ("b", "1"), ("c", "1"))})
    with pytest.raises(ValueError, match="more than 2"):
        flatten_events(events, "view", max_keys=2)
    assert flatten_events(events, "view", max_keys=3).count() == 1


def test_value_struct_with_another_slot(spark):
    wide = PARAMS.replace("double_value: double", "double_value: double, set_micros: bigint")
    schema = SCHEMA.replace(f"event_params {PARAMS}", f"event_params {wide}")
    entries = [("a", (None, None, None, None, 5)), ("a", ("x", None, None, None, 5))]
    flat = flatten_events(frame(spark, {"event_params": entries}, schema=schema), "view")
    assert structs(flat) == [{"a": "x"}]
