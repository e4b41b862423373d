"""Parameter arrays as rows, as keys and as one struct per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import (
    ITEMS_KEY,
    PARAMS,
    SLOTS,
    entries_with_value,
    has_pivot_key,
    keyed_once,
    keys_set,
    literal,
    param_value,
    quoted,
    texts_by_key,
    value_text,
    with_key,
)
from .columns import hashable

# Columns that tell events apart; events equal on all of them are one.
EVENT_IDENTITY = (
    "user_pseudo_id",
    "user_id",
    "event_name",
    "event_date",
    "event_timestamp",
    "geo",
    "device",
    "items",
    "user_properties",
    "batch_event_index",
)

# Keys that stay top-level columns and are left out of the struct.
IDENTIFIER_KEYS = ("user_pseudo_id", "user_id")

SESSION_KEY = "ga_session_id"

#: Keys from which on reading all of them in one pass is faster than looking up each.
ONE_PASS_KEYS = 64


def explode_params(data: DataFrame, *carry: str) -> DataFrame:
    """One row per (event, parameter); events without parameters give none."""
    entries = data.select(*carry, F.explode(PARAMS).alias("entry"))
    return entries.select(*carry, "entry.key", *[f"entry.value.{slot}" for slot in SLOTS])


def distinct_param_keys(data: DataFrame) -> DataFrame:
    """The keys in use, ``items`` and NULL excluded; the scan reads the key column only."""
    keys = data.select(F.explode(f"{PARAMS}.key").alias("key"))
    return keys.where(F.col("key") != ITEMS_KEY).distinct()


def discover_param_keys(data: DataFrame, max_keys: int | None = None) -> list[str]:
    """The keys in use, sorted, on the driver: they become field names of the output.

    There is no limit unless the caller sets one; more than ``max_keys`` are then an error.
    """
    keys = distinct_param_keys(data)
    rows = (keys if max_keys is None else keys.limit(max_keys + 1)).collect()
    if max_keys is not None and len(rows) > max_keys:
        raise ValueError(
            f"more than {max_keys} distinct parameter keys; raise max_keys or name param_keys"
        )
    return sorted(row["key"] for row in rows)


def struct_keys(keys: Sequence[str], case_sensitive: bool = False) -> list[str]:
    """The keys that become struct fields, in the order given."""
    fields = [key for key in dict.fromkeys(keys) if key not in (ITEMS_KEY, *IDENTIFIER_KEYS)]
    if not case_sensitive:
        spellings: dict[str, list[str]] = {}
        for key in fields:
            spellings.setdefault(key.lower(), []).append(key)
        clashes = [sorted(group) for group in spellings.values() if len(group) > 1]
        if clashes:
            raise ValueError(f"parameter keys differ only in case: {sorted(clashes)}")
    return fields


def identity_hash(data: DataFrame, carried: Sequence[str]) -> str | None:
    """A 64-bit hash of the columns, but for those Spark cannot hash; None if that is all."""
    hashed = [quoted(name) for name in carried if hashable(data.schema[name].dataType)]
    return f"xxhash64({', '.join(hashed)})" if hashed else None


def pivot_params(
    events: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    merge: bool = True,
    one_pass_keys: int | None = None,
) -> DataFrame:
    """Turn ``event_params`` into a struct with one text field per key.

    Gives the ``carry`` columns, ``session_text`` (text of the session parameter, whether
    or not it is among the keys) and ``event_params``. Nothing is exploded: a few keys are
    looked up one by one inside their row, from ``one_pass_keys`` (``ONE_PASS_KEYS``) on all
    are read in one pass, with the same result. With ``merge`` the events equal on all ``carry`` columns become one row: per key
    the first value that is set, events being ordered by a fingerprint of their parameters.
    The merge is a partial aggregate, so copies of an event collapse before they are
    shuffled; its first key is a hash of the others, which settles nearly every comparison.
    """
    one_pass = len(keys) >= (ONE_PASS_KEYS if one_pass_keys is None else one_pass_keys)
    carried = [quoted(name) for name in carry]
    value_type = events.schema[PARAMS].dataType.elementType["value"].dataType
    rows = events.where(has_pivot_key()).selectExpr(
        *carried,
        f"{entries_with_value(value_type)} as _entries",
        f"xxhash64({PARAMS}) as _fingerprint",
    )
    kept = [*carried, "_fingerprint"]
    if not one_pass:
        wanted = list(keys) if SESSION_KEY in keys else [*keys, SESSION_KEY]
        names = {key: f"_param_{number}" for number, key in enumerate(wanted)}
        # Values first, their texts then: one search per key, not one per slot.
        values = [f"{param_value(key, '_entries')} as {name}" for key, name in names.items()]
        texts = rows.selectExpr(*kept, *values).selectExpr(
            *kept, *[f"{value_text(name)} as {name}" for name in names.values()]
        )
        session = names[SESSION_KEY]
    else:
        session = "_session"
        names = {key: f"_texts.{quoted(key)}" for key in keys}
        # Keys are a column of their own: a search in it does not gather them again.
        rows = rows.selectExpr(
            *kept, f"{with_key('_entries')} as _entries", f"{keys_set('_entries')} as _keys"
        )
        rows = rows.selectExpr(
            *kept,
            f"{keyed_once('_entries', '_keys')} as _entries",
            f"{param_value(SESSION_KEY, '_entries')} as _session",
        )
        texts = rows.selectExpr(
            *kept,
            f"{texts_by_key(keys, '_entries')} as _texts",
            f"{value_text('_session')} as _session",
        )
    if merge:
        first = "min_by({0}, if({0} is null, null, _fingerprint)) as {1}"
        merged = {name: f"_param_{number}" for number, name in enumerate([*names.values()])}
        merged.setdefault(session, "_session")
        identity = identity_hash(events, carry)
        grouped = texts.selectExpr("*", f"{identity} as _identity") if identity else texts
        texts = grouped.groupBy(*(["_identity"] if identity else []), *carried).agg(
            *[F.expr(first.format(name, own)) for name, own in merged.items()]
        )
        names = {key: merged[name] for key, name in names.items()}
        session = merged[session]
    elif one_pass:
        return texts.selectExpr(*carried, "_session as session_text", f"_texts as {PARAMS}")
    fields = ", ".join(f"{literal(key)}, {names[key]}" for key in keys)
    return texts.selectExpr(
        *carried, f"{session} as session_text", f"named_struct({fields}) as {PARAMS}"
    )
