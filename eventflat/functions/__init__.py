"""Expressions: parameters, identity, defaults."""

from .fields import (
    BATCH_COLUMNS,
    COLLECTED_TRAFFIC_SOURCE,
    SESSION_TRAFFIC_SOURCE_LAST_CLICK,
    default_traffic_columns,
)
from .identity import event_day, event_millis, session_id
from .params import (
    entries_with_value,
    has_pivot_key,
    param_lookup,
    param_value,
    slot_value,
    value_text,
)

__all__ = [
    "BATCH_COLUMNS",
    "COLLECTED_TRAFFIC_SOURCE",
    "SESSION_TRAFFIC_SOURCE_LAST_CLICK",
    "default_traffic_columns",
    "entries_with_value",
    "event_day",
    "event_millis",
    "has_pivot_key",
    "param_lookup",
    "param_value",
    "session_id",
    "slot_value",
    "value_text",
]
