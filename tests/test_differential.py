"""Both jobs against their plain forms, and properties over random events."""

from __future__ import annotations

from collections import defaultdict

import pytest
from frames import DEFAULTS, Slots, frame, params
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plain import explode_and_pivot, windowed_sessions

from eventflat import flatten_events, flatten_sessions
from eventflat.fixture import load_nested_events
from eventflat.operators import discover_param_keys, keep_events
from eventflat.operators.sessions import SESSION_COLUMNS

FOLDER = "/root/testdata/sf0.01"


def same_rows(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("name", ["click", "purchase"])
def test_events_equal_explode_and_pivot(spark, name):
    nested = load_nested_events(spark, FOLDER)
    keys = discover_param_keys(keep_events(nested, name))
    plain = explode_and_pivot(nested, f"event_name = '{name}'", keys)
    ours = flatten_events(nested, name)
    assert plain.count() > 1000
    assert same_rows(ours, plain)


def test_sessions_equal_windows(spark):
    nested = load_nested_events(spark, FOLDER, collected=True)
    plain = windowed_sessions(nested).select(*SESSION_COLUMNS)
    assert same_rows(flatten_sessions(nested), plain)


KEYS = ["a", "b", "items", "ga_session_id", None]
CONTENT = st.one_of(
    st.none(),
    st.sampled_from(["", "x", "y"]),
    st.integers(0, 3),
    st.just(Slots((None, None, None, None))),
    st.just(Slots((None, None, 0.5, None))),
)
EVENT = st.fixed_dictionaries(
    {
        "event_timestamp": st.integers(1, 3),
        "user_pseudo_id": st.sampled_from(["p1", "p2", None]),
        "event_name": st.sampled_from(["view", "click"]),
        "event_params": st.one_of(
            st.none(), st.lists(st.tuples(st.sampled_from(KEYS), CONTENT), max_size=5)
        ),
        "items": st.one_of(
            st.none(), st.lists(st.sampled_from([None, ("i1", 1.0), ("i2", 2.0)]), max_size=3)
        ),
    }
)
EVENTS = st.lists(EVENT, min_size=1, max_size=12)
SETTINGS = settings(
    max_examples=12,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def build(spark, events):
    rows = [
        {**event, "event_params": event["event_params"] and params(*event["event_params"])}
        for event in events
    ]
    return frame(spark, *rows)


def text(content) -> str | None:
    if content is None:
        return None
    if isinstance(content, Slots):
        return next((str(slot) for slot in content if slot is not None), None)
    return str(content)


@SETTINGS
@given(EVENTS)
def test_random_events_match_brute_force(spark, events):
    groups = defaultdict(list)
    for event in events:
        entries = [entry for entry in event["event_params"] or [] if entry[0] not in (None, "items")]
        if entries:
            identity = (
                event["user_pseudo_id"],
                event["event_name"],
                event["event_timestamp"],
                str(event["items"]),
            )
            groups[identity].append(entries)
    keys = sorted({key for group in groups.values() for entries in group for key, _ in entries})

    flat = flatten_events(build(spark, events), event_list=["view", "click"])
    assert flat.schema["event_params"].dataType.fieldNames() == keys
    found = flat.collect()
    assert len(found) == len(groups)
    for row in found:
        items = row["items"] if row["items"] is None else [i and tuple(i) for i in row["items"]]
        group = groups[
            (row["user_pseudo_id"], row["event_name"], row["event_timestamp"], str(items))
        ]
        for key in keys:
            firsts = {
                next((text(c) for k, c in entries if k == key and text(c) is not None), None)
                for entries in group
            }
            allowed = firsts - {None} or {None}
            assert row["event_params"][key] in allowed


@SETTINGS
@given(EVENTS, st.integers(2, 6))
def test_order_and_width_do_not_matter(spark, events, width):
    forward = build(spark, events)
    backward = build(spark, list(reversed(events))).repartition(width)
    names = ["view", "click"]
    for job in (
        lambda data: flatten_events(data, event_list=names),
        lambda data: flatten_events(data, event_list=names, event_type="ecommerce"),
        flatten_sessions,
    ):
        assert same_rows(job(forward), job(backward))


def test_hot_groups_give_whole_results(spark):
    """A third of the rows are copies of one event, a third one long session."""
    def event(number: int) -> dict:
        kind = number % 3
        if kind == 0:
            return {"event_params": params(("ga_session_id", 1), ("a", "copy"))}
        user = "bot" if kind == 1 else f"p{number}"
        return {
            "user_pseudo_id": user,
            "event_timestamp": number * 1_000_000,
            "event_params": params(("ga_session_id", 2), ("page_location", f"page {number}")),
        }

    events = frame(spark, *[event(number) for number in range(3000)]).repartition(16)
    flat = flatten_events(events, DEFAULTS["event_name"])
    assert flat.count() == 2001
    sessions = {row["user_pseudo_id"]: row for row in flatten_sessions(events).collect()}
    assert len(sessions) == 1002
    assert sessions["bot"]["session_landing_page"] == "page 1"
    assert sessions["bot"]["session_exit_page"] == "page 2998"
