"""Expressions over the repeated key/value array ``event_params``.

They are written as SQL text: a pivot over many keys is then built in one call instead of
a dozen per key. Single look-ups go through ``array_position`` on the key array instead of a
lambda: they can be compiled, as long as a projection has few enough nested fields, and a
look-up of one typed slot lets the parquet scan skip the other slots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAMS = "event_params"
ITEMS_KEY = "items"

# Typed slots of a value, in the order in which they are tried.
SLOTS = ("string_value", "int_value", "float_value", "double_value")


def literal(text: str) -> str:
    """A text as SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """A column name as SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def value_text(value: str) -> str:
    """A typed value as text: string, int, float, double, whichever is set first."""
    return "coalesce(" + ", ".join(f"cast({value}.{slot} as string)" for slot in SLOTS) + ")"


def position_of(key: str, params: str = PARAMS) -> str:
    """Array index of the first entry with this key; -1 when there is none."""
    return f"array_position({params}.key, {literal(key)}) - 1"


def param_value(key: str, params: str = PARAMS) -> str:
    """The whole value of the first entry with this key; NULL when there is none."""
    return f"get({params}.value, {position_of(key, params)})"


def slot_value(key: str, slot: str, params: str = PARAMS) -> str:
    """One typed slot of the first entry with this key; NULL when there is none."""
    return f"get({params}.value.{slot}, {position_of(key, params)})"


def param_lookup(key: str, slot: str, params: str = PARAMS) -> Column:
    """``slot_value`` as a column."""
    return F.expr(slot_value(key, slot, params))


def entries_with_value(value_type: T.StructType, params: str = PARAMS) -> str:
    """The entries that carry a value, in array order.

    Nearly always that is all of them. A compiled search for a valueless entry settles it
    without a lambda; the filter runs on the few arrays that have one.
    """
    kept = f"filter({params}, entry -> {value_text('entry.value')} is not null)"
    if set(value_type.fieldNames()) != set(SLOTS):
        return kept
    fields = ", ".join(
        f"{literal(field.name)}, cast(null as {field.dataType.simpleString()})"
        for field in value_type.fields
    )
    valueless = f"array_contains({params}.value, named_struct({fields}))"
    return f"if({valueless} = false, {params}, {kept})"


def has_pivot_key(params: str = PARAMS) -> str:
    """True when some key other than ``items`` is present."""
    return f"array_max(array_remove({params}.key, {literal(ITEMS_KEY)})) is not null"


def keyed_once(params: str, keys: str) -> str:
    """The first entry of each key, in array order; ``keys`` holds the keys of the entries.

    That is nearly always all of them, which is settled without a lambda.
    """
    return (
        f"if(size(array_distinct({keys})) = size({params}), {params}, "
        f"filter({params}, (entry, place) -> array_position({keys}, entry.key) = place + 1))"
    )


def keys_set(params: str) -> str:
    """The keys of the entries that have one, in array order."""
    return f"filter({params}.key, key -> key is not null)"


def with_key(params: str) -> str:
    """The entries that have a key."""
    kept = f"filter({params}, entry -> entry.key is not null)"
    # False only if no key is NULL.
    return f"if(array_contains({params}.key, '') = false, {params}, {kept})"


def texts_by_key(keys: Sequence[str], params: str) -> str:
    """A struct of the texts of all these keys in one pass over entries with distinct keys.

    The entries become one object, whose fields the cast puts to their places by name: the
    cost is the number of entries and keys, not their product.
    """
    texts = f"transform({params}, entry -> {value_text('entry.value')})"
    fields = ", ".join(f"{quoted(key)}: string" for key in keys)
    return f"cast(to_variant_object(map_from_arrays({params}.key, {texts})) as struct<{fields}>)"
