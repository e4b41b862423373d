"""Session identity, event day and event time, as SQL text."""

from __future__ import annotations

from .params import slot_value


def session_id(session: str, user: str = "user_pseudo_id") -> str:
    """Client id and session number joined without separator; NULL if either is NULL."""
    return f"concat({user}, {session})"


def event_day(text: str = "event_date") -> str:
    """The export's ``yyyyMMdd`` text as a date; malformed text is an error under ANSI."""
    return f"to_date({text}, 'yyyyMMdd')"


def event_millis() -> str:
    """Ordering time of an event: its own clock if sent, else the export time, in ms."""
    own = slot_value("custom_timestamp", "int_value")
    return f"coalesce({own}, event_timestamp div 1000)"
