"""Which events to keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def like_prefix(pattern: str) -> str:
    """The plain text that every name matching a LIKE pattern starts with."""
    found, letters = [], iter(pattern)
    for letter in letters:
        if letter in "%_":
            break
        found.append(next(letters, "") if letter == "\\" else letter)
    return "".join(found)


def keep_events(
    data: DataFrame,
    event_name: str | None = None,
    event_list: Sequence[str] | None = None,
    event_pattern: str | None = None,
) -> DataFrame:
    """Events of a list of names, else of a LIKE pattern, else of one name.

    Each form reaches a parquet scan as a pushed filter where the source can use it. Spark
    itself pushes no pattern with ``_`` or an escape in it, which nearly all names call for:
    the plain text in front of the first wildcard goes along as a prefix of its own.
    """
    name = F.col("event_name")
    if event_list:
        return data.where(name.isin(*event_list))
    if event_pattern:
        prefix = like_prefix(event_pattern)
        matches = name.like(event_pattern)
        return data.where(name.startswith(prefix) & matches if prefix else matches)
    if event_name is None:
        raise ValueError("give event_name, event_list or event_pattern")
    return data.where(name == event_name)


def keep_events_with_items(data: DataFrame) -> DataFrame:
    """Events whose ``items`` array has at least one element, NULL elements included."""
    return data.where(F.size("items") > 0)
