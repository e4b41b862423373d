"""From events to session rows.

One aggregate over the joined session id reduces the events of a session to its features
and the distinct days it was active on. Minima, maxima and the set of days combine before
the shuffle, so a session of any length leaves each task as one row. The days are then
spread to rows, each with all features of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import default_traffic_columns
from ..functions.identity import event_day, event_millis, session_id
from ..functions.params import PARAMS, param_lookup, quoted, slot_value
from .columns import has_column, hashable

# Columns of an event that sessions are made of.
SESSION_INPUT = (
    "event_date",
    "event_timestamp",
    "event_name",
    "event_params",
    "user_id",
    "user_pseudo_id",
    "device",
    "geo",
    "traffic_source",
)

# Traffic sources; the first two may be absent.
TRAFFIC_COLUMNS = (
    "session_traffic_source_last_click",
    "collected_traffic_source",
    "traffic_source",
)

# Columns of a session row, in order.
SESSION_COLUMNS = (
    "session_id",
    "session_date",
    "session_start_timestamp",
    "session_end_timestamp",
    "ga_session_id",
    "ga_session_number",
    "user_pseudo_id",
    "user_id",
    "session_landing_page",
    "session_exit_page",
    "session_referrer_page",
    "session_traffic_source_last_click",
    "collected_traffic_source",
    "traffic_source",
    "device",
    "geo",
    "is_engaged_session",
)

def select_session_input(data: DataFrame) -> DataFrame:
    """The columns sessions are made of, with the optional ones that are there."""
    optional = [name for name in TRAFFIC_COLUMNS[:2] if has_column(data, name)]
    return data.select(*[F.col(name).alias(name) for name in (*SESSION_INPUT, *optional)])


def events_in_sessions(data: DataFrame) -> DataFrame:
    """Events with a client id and an integer session parameter, added as a column."""
    return (
        data.where("user_pseudo_id is not null")
        .withColumn("ga_session_id", param_lookup("ga_session_id", "int_value"))
        .where("ga_session_id is not null")
    )


def with_session_params(events: DataFrame) -> DataFrame:
    """Typed parameters and ordering time of each event of a session, and their fingerprint.

    The fingerprint takes the typed slots in use, so that the scan reads no other.
    """
    slots = ", ".join(f"{PARAMS}.value.{slot}" for slot in ("string_value", "int_value"))
    return events.selectExpr(
        "*",
        f"{event_day()} as session_date",
        f"{event_millis()} as ordering_timestamp",
        f"{slot_value('ga_session_number', 'int_value')} as ga_session_number",
        f"{slot_value('page_location', 'string_value')} as page_location",
        f"{slot_value('page_referrer', 'string_value')} as page_referrer",
        f"{slot_value('session_engaged', 'string_value')} as session_engaged",
        f"xxhash64({PARAMS}.key, {slots}) as params_tie",
    )


def _moment(events: DataFrame, traffic: list[str]) -> str:
    """The place of an event in its session.

    Ties beyond time and name are settled by the fingerprint of the parameters, then by one
    of the other columns; maps have no fingerprint.
    """
    others = ("user_id", "user_pseudo_id", "device", "geo", *traffic)
    hashed = [quoted(name) for name in others if hashable(events.schema[name].dataType)]
    return (
        "struct(ordering_timestamp, event_timestamp, event_name, params_tie, "
        f"xxhash64({', '.join(hashed)}) as rest_tie)"
    )


def whole_sessions(events: DataFrame) -> DataFrame:
    """One row per joined session id: its features, and its days in order.

    Two clients whose joined ids coincide share features, as the export's consumers know
    sessions by that id, but their days stay apart. A day's engagement is reduced to one
    of four levels, so that the set holds a few entries per day however many events it had.
    """
    traffic = [name for name in TRAFFIC_COLUMNS if name in events.columns]
    level = """case when session_engaged < '1' then 1 when session_engaged = '1' then 2
      when session_engaged > '1' then 3 else 0 end"""
    placed = events.selectExpr(
        "*",
        f"{session_id('ga_session_id')} as session_id",
        f"{_moment(events, traffic)} as moment",
        f"""struct(struct(ga_session_id, user_pseudo_id, session_date) as day,
                   {level} as engagement) as active""",
    )
    first = "struct(ordering_timestamp, page_location, page_referrer, device, geo)"
    features = [
        "max(ga_session_number) as ga_session_number",
        "max(user_id) as user_id",
        f"min_by({first}, moment) as first_event",
        "max_by(struct(ordering_timestamp, page_location), moment) as last_event",
        *[f"min_by({name}, moment) filter (where {name} is not null) as {name}" for name in traffic],
        "array_sort(collect_set(active)) as days",
    ]
    return placed.groupBy("session_id").agg(*[F.expr(feature) for feature in features])


def session_rows(sessions: DataFrame) -> DataFrame:
    """Session features on each day of the session.

    Entries of a day lie side by side, so the last one has the greatest engagement.
    """
    last_of_day = "filter(days, (entry, place) -> not (get(days, place + 1).day <=> entry.day))"
    spread = sessions.selectExpr("*", f"explode({last_of_day}) as active").drop("days")
    found = {name: name for name in SESSION_COLUMNS}
    absent = default_traffic_columns()
    found |= {name: absent[name] for name in absent if name not in sessions.columns}
    found |= {
        "session_date": "active.day.session_date",
        "ga_session_id": "active.day.ga_session_id",
        "user_pseudo_id": "active.day.user_pseudo_id",
        "session_start_timestamp": "first_event.ordering_timestamp",
        "session_end_timestamp": "last_event.ordering_timestamp",
        "session_landing_page": "first_event.page_location",
        "session_exit_page": "last_event.page_location",
        "session_referrer_page": "first_event.page_referrer",
        "device": "first_event.device",
        "geo": "first_event.geo",
        "is_engaged_session": "active.engagement = 2",
    }
    return spread.selectExpr(*[f"{found[name]} as {name}" for name in SESSION_COLUMNS])
