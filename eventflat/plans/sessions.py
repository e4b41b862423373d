"""Session aggregation: nested export events to one row per session and day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sessions import (
    events_in_sessions,
    select_session_input,
    session_rows,
    whole_sessions,
    with_session_params,
)


def flatten_sessions(data: DataFrame) -> DataFrame:
    """One row per session and day; features span the session, engagement the day.

    An optional traffic-source column that the input lacks is constant, so it is added
    to the finished rows instead of travelling through the shuffle.
    """
    events = with_session_params(events_in_sessions(select_session_input(data)))
    return session_rows(whole_sessions(events))


def has_sessions(data: DataFrame) -> bool:
    """Whether ``flatten_sessions`` gives any row: stops at the first event that does."""
    return not events_in_sessions(data).select("ga_session_id").isEmpty()
