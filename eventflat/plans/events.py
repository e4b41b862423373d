"""Event flattening: nested export events to one wide row per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.identity import event_day, session_id
from ..functions.params import has_pivot_key, quoted
from ..operators.columns import with_batch_defaults
from ..operators.filters import keep_events, keep_events_with_items
from ..operators.items import recollect_items
from ..operators.params import (
    EVENT_IDENTITY,
    discover_param_keys,
    pivot_params,
    struct_keys,
)

# Columns of a flattened event, in order, before the caller's extras.
EVENT_COLUMNS = (
    "user_pseudo_id",
    "user_id",
    "session_id",
    "event_name",
    "event_date",
    "event_timestamp",
    "batch_event_index",
    "geo",
    "device",
    "items",
    "user_properties",
    "event_params",
)

ECOMMERCE = "ecommerce"


def flatten_events(
    data: DataFrame,
    event_name: str | None = None,
    event_type: str = "standard",
    additional_columns_to_select: Sequence[str] | None = None,
    event_list: Sequence[str] | None = None,
    event_pattern: str = "",
    *,
    param_keys: Sequence[str] | None = None,
    assume_unique: bool = False,
    num_partitions: int | None = None,
    max_keys: int | None = None,
    item_parts: int = 1,
) -> DataFrame:
    """One row per event of the kept names, parameters as fields of a struct.

    ``param_keys`` pins the fields of the struct and their order; without it one scan of
    the key column finds them. ``assume_unique`` states that no two events agree on all
    identity columns and spares the merge and its shuffle. ``num_partitions`` spreads
    the kept events over that many tasks first, for a source with too few splits.
    ``item_parts`` gathers the items of an e-commerce row in so many parts first, see
    ``recollect_items``.
    """
    events = with_batch_defaults(keep_events(data, event_name, event_list, event_pattern))
    keys = discover_param_keys(events, max_keys) if param_keys is None else list(param_keys)
    if param_keys is None and not keys:
        events = events.where("false")
    if num_partitions:
        events = events.repartition(num_partitions)

    extras = [
        name
        for name in dict.fromkeys(additional_columns_to_select or [])
        if name not in EVENT_IDENTITY
    ]
    case_sensitive = data.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    pivoted = pivot_params(
        events,
        struct_keys(keys, case_sensitive),
        [*EVENT_IDENTITY, *extras],
        merge=not assume_unique,
    )
    computed = {
        "session_id": f"{session_id('session_text')} as session_id",
        "event_date": f"{event_day()} as event_date",
    }
    flat = pivoted.selectExpr(
        *[computed.get(name, name) for name in EVENT_COLUMNS], *[quoted(name) for name in extras]
    )
    return recollect_items(flat, item_parts) if event_type == ECOMMERCE else flat


def has_events_to_flatten(
    data: DataFrame,
    event_name: str | None = None,
    event_type: str = "standard",
    event_list: Sequence[str] | None = None,
    event_pattern: str = "",
) -> bool:
    """Whether ``flatten_events`` gives any row: stops at the first event that does."""
    events = keep_events(data, event_name, event_list, event_pattern).where(has_pivot_key())
    if event_type == ECOMMERCE:
        events = keep_events_with_items(events)
    return not events.select("event_name").isEmpty()
