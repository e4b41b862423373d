"""DataFrame to DataFrame steps the plans are made of."""

from .columns import with_batch_defaults, with_traffic_defaults
from .filters import keep_events, keep_events_with_items
from .items import recollect_items
from .key_index import indexed_param_keys, update_key_index
from .params import discover_param_keys, distinct_param_keys, explode_params, pivot_params
from .sessions import events_in_sessions, session_rows, whole_sessions, with_session_params
from .spread import spread_large_tasks

__all__ = [
    "discover_param_keys",
    "distinct_param_keys",
    "events_in_sessions",
    "explode_params",
    "indexed_param_keys",
    "keep_events",
    "keep_events_with_items",
    "pivot_params",
    "recollect_items",
    "session_rows",
    "spread_large_tasks",
    "update_key_index",
    "whole_sessions",
    "with_batch_defaults",
    "with_session_params",
    "with_traffic_defaults",
]
