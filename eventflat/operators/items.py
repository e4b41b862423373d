"""The ``items`` array of e-commerce events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import quoted
from .columns import hashable
from .filters import keep_events_with_items

# Flattened events equal on these share one items array.
ITEMS_GRAIN = ("user_pseudo_id", "session_id", "event_timestamp")


def recollect_items(flat: DataFrame, parts: int = 1) -> DataFrame:
    """One row per (user, session, timestamp) holding the items of all its events.

    Events without items give nothing, NULL items are skipped and repeats stay. The other
    columns are those of the first event by name, then by a fingerprint of the row; the
    items follow the same order, then their place in the array.

    A row's items come together in one task in any case, as they are one array. With
    ``parts`` (a power of two) they are first gathered and sorted in that many parts of each
    event name, ranges of the fingerprint, in tasks of their own: the last step only puts
    sorted parts one after another. It is a second shuffle, for exports in which single
    triples have very many items; the result is the same.
    """
    if parts < 1 or parts & (parts - 1):
        raise ValueError("parts must be a power of two")
    rest = [quoted(name) for name in flat.columns if name not in (*ITEMS_GRAIN, "items")]
    hashed = [quoted(field.name) for field in flat.schema.fields if hashable(field.dataType)]
    events = keep_events_with_items(flat).selectExpr(
        *ITEMS_GRAIN,
        "items",
        f"struct(event_name, xxhash64({', '.join(hashed)}) as tie) as _order",
        f"struct({', '.join(rest)}) as _rest",
    )
    if parts > 1:
        # The upper bits of the fingerprint, sign included: parts are in order, as events are.
        bits = 64 - (parts.bit_length() - 1)
        part = f"struct(_order.event_name as name, shiftright(_order.tie, {bits}) as place)"
        events = events.groupBy(*ITEMS_GRAIN, F.expr(part).alias("_part")).agg(
            F.expr("min_by(_rest, _order) as _rest"),
            F.expr("flatten(array_sort(collect_list(struct(_order, items))).items) as items"),
            F.expr("min(_order) as _order"),
        )
    key = "_part" if parts > 1 else "_order"
    merged = events.groupBy(*ITEMS_GRAIN).agg(
        F.expr("min_by(_rest, _order) as _rest"),
        F.expr(f"array_sort(collect_list(struct({key}, items))) as _parts"),
    )
    items = "filter(flatten(_parts.items), item -> item is not null) as items"
    return merged.selectExpr(*ITEMS_GRAIN, items, "_rest.*").select(
        *[quoted(name) for name in flat.columns]
    )
