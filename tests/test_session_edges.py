"""Hand-made rows for session aggregation (X-14 to X-22 of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

import pytest
from frames import SCHEMA, frame, params

from eventflat import flatten_sessions
from eventflat.functions import COLLECTED_TRAFFIC_SOURCE, SESSION_TRAFFIC_SOURCE_LAST_CLICK
from eventflat.operators.sessions import SESSION_COLUMNS

SESSION = ("ga_session_id", 7)


def at(second: int, *entries, **columns) -> dict:
    return {
        "event_timestamp": second * 1_000_000,
        "event_params": params(SESSION, *entries),
        **columns,
    }


def rows(sessions) -> list:
    return sessions.orderBy("user_pseudo_id", "session_date").collect()


def test_x14_session_across_midnight(spark):
    events = frame(
        spark,
        at(1, ("page_location", "one"), ("session_engaged", "0")),
        at(9, ("page_location", "two"), ("session_engaged", "1"), event_date="20240102"),
    )
    first, second = rows(flatten_sessions(events))
    assert (first["session_date"], second["session_date"]) == (
        dt.date(2024, 1, 1),
        dt.date(2024, 1, 2),
    )
    for row in (first, second):
        assert row["session_start_timestamp"] == 1000
        assert row["session_end_timestamp"] == 9000
        assert row["session_landing_page"] == "one"
        assert row["session_exit_page"] == "two"
    assert (first["is_engaged_session"], second["is_engaged_session"]) == (False, True)


def test_x15_first_event_is_kept_with_its_nulls(spark):
    events = frame(spark, at(1, device=None), at(2, ("page_location", "late")))
    (row,) = rows(flatten_sessions(events))
    assert row["session_landing_page"] is None
    assert row["device"] is None
    assert row["session_exit_page"] == "late"


def test_last_event_without_page(spark):
    (row,) = rows(flatten_sessions(frame(spark, at(1, ("page_location", "one")), at(2))))
    assert row["session_landing_page"] == "one"
    assert row["session_exit_page"] is None


def test_x16_traffic_skips_nulls(spark):
    events = frame(spark, at(1), at(2, traffic_source=("m", "n", "s")), at(3, traffic_source=None))
    (row,) = rows(flatten_sessions(events))
    assert tuple(row["traffic_source"]) == ("m", "n", "s")


def test_x16_traffic_from_an_earlier_day(spark):
    events = frame(
        spark,
        at(1, traffic_source=("m", "n", "s")),
        at(2, traffic_source=("x", "y", "z"), event_date="20240102"),
    )
    first, second = rows(flatten_sessions(events))
    assert tuple(first["traffic_source"]) == tuple(second["traffic_source"]) == ("m", "n", "s")


@pytest.mark.parametrize(
    ("values", "engaged"),
    [([1], False), (["1", "true"], False), (["1", "2"], False), (["0", "1"], True), ([], False)],
)
def test_x17_engagement(spark, values, engaged):
    events = frame(spark, at(0), *[at(1, ("session_engaged", value)) for value in values])
    (row,) = rows(flatten_sessions(events))
    assert row["is_engaged_session"] is engaged


def test_x18_events_outside_sessions(spark):
    events = frame(
        spark,
        {"event_params": params(("ga_session_id", "7"))},
        {"user_pseudo_id": None, "event_params": params(SESSION)},
        {"event_params": None},
        {"event_params": params(("ga_session_id", "text"), SESSION)},
    )
    assert flatten_sessions(events).collect() == []


def test_x19_own_clock_decides(spark):
    events = frame(
        spark,
        at(1, ("page_location", "a"), ("custom_timestamp", 50_000)),
        at(2, ("page_location", "b"), ("custom_timestamp", 3)),
    )
    (row,) = rows(flatten_sessions(events))
    assert (row["session_landing_page"], row["session_exit_page"]) == ("b", "a")
    assert (row["session_start_timestamp"], row["session_end_timestamp"]) == (3, 50_000)


def test_event_without_any_time_comes_first(spark):
    events = frame(
        spark,
        at(5, ("page_location", "a")),
        {"event_timestamp": None, "event_params": params(SESSION, ("page_location", "b"))},
    )
    (row,) = rows(flatten_sessions(events))
    assert row["session_landing_page"] == "b"
    assert row["session_start_timestamp"] is None
    assert row["session_end_timestamp"] == 5000


def test_x20_coinciding_ids_share_features(spark):
    def one(user, session, second, page):
        entries = params(("ga_session_id", session), ("page_location", page))
        return {
            "user_pseudo_id": user,
            "event_timestamp": second * 1_000_000,
            "event_params": entries,
        }

    events = frame(spark, one("1", 23, 1, "first"), one("12", 3, 2, "last"))
    found = rows(flatten_sessions(events))
    assert [(row["user_pseudo_id"], row["ga_session_id"]) for row in found] == [
        ("1", 23),
        ("12", 3),
    ]
    for row in found:
        assert row["session_id"] == "123"
        assert (row["session_landing_page"], row["session_exit_page"]) == ("first", "last")


def test_x21_absent_columns_default(spark):
    (row,) = rows(flatten_sessions(frame(spark, at(1))))
    assert row["collected_traffic_source"].asDict() == dict.fromkeys(COLLECTED_TRAFFIC_SOURCE, "")
    last_click = row["session_traffic_source_last_click"].asDict(recursive=True)
    assert last_click == {
        campaign: dict.fromkeys(names, "")
        for campaign, names in SESSION_TRAFFIC_SOURCE_LAST_CLICK.items()
    }
    assert [len(names) for names in SESSION_TRAFFIC_SOURCE_LAST_CLICK.values()] == [
        9, 6, 7, 10, 20, 19,
    ]


def test_x21_null_columns_stay_null(spark):
    schema = SCHEMA + ", collected_traffic_source struct<gclid: string>"
    events = frame(spark, {**at(1), "collected_traffic_source": None}, schema=schema)
    (row,) = rows(flatten_sessions(events))
    assert row["collected_traffic_source"] is None


def test_missing_traffic_source_is_an_error(spark):
    with pytest.raises(Exception, match="traffic_source"):
        flatten_sessions(frame(spark, at(1)).drop("traffic_source"))


def test_x22_dates(spark):
    (row,) = rows(flatten_sessions(frame(spark, at(1, event_date=None))))
    assert row["session_date"] is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
        flatten_sessions(frame(spark, at(1, event_date="january"))).collect()


def test_identity_features(spark):
    events = frame(
        spark,
        at(1, ("ga_session_number", 2)),
        at(2, ("ga_session_number", 4), user_id="a", event_date="20240102"),
        at(3, ("ga_session_number", "9"), user_id="b"),
    )
    sessions = flatten_sessions(events)
    assert sessions.columns == list(SESSION_COLUMNS)
    for row in rows(sessions):
        assert (row["ga_session_number"], row["user_id"], row["session_id"]) == (4, "b", "p17")


def test_equal_times_are_settled_the_same_way(spark):
    events = frame(
        spark,
        *[
            at(1, ("page_location", page), event_name=name, device=(page, name))
            for page, name in (("x", "b"), ("y", "a"), ("z", "a"), ("w", "c"))
        ],
    )
    expected = rows(flatten_sessions(events))
    (row,) = expected
    # The names leave y and z; a fingerprint settles them, and the features are one event's.
    assert row["session_landing_page"] in ("y", "z")
    assert row["device"]["category"] == row["session_landing_page"]
    assert row["session_exit_page"] == "w"
    for width in (2, 3, 7):
        assert rows(flatten_sessions(events.repartition(width))) == expected


def test_maps_inside_opaque_columns(spark):
    events = frame(spark, at(1, ("page_location", "a")), at(2, ("page_location", "b")))
    mapped = events.selectExpr("* except (geo)", "struct(map('c', event_timestamp) as m) as geo")
    (row,) = rows(flatten_sessions(mapped))
    assert row["geo"]["m"] == {"c": 1_000_000}
    assert (row["session_landing_page"], row["session_exit_page"]) == ("a", "b")


def test_traffic_column_in_another_case(spark):
    schema = SCHEMA + ", Collected_Traffic_Source struct<gclid: string>"
    events = frame(spark, {**at(1), "Collected_Traffic_Source": ("g",)}, schema=schema)
    (row,) = rows(flatten_sessions(events))
    assert row["collected_traffic_source"]["gclid"] == "g"
