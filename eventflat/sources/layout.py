"""Arguments shared by sources and sinks, checked before any Spark work."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.params import quoted
from ..operators.columns import hashable

# Layouts of a source.
FLAT = "flat"
DATED = "date_partitioned"

#: Files that one task of a write of small files has, until there are as many tasks as below.
FILES_PER_TASK = 100
#: A task more is a range more to sample bounds for, so tasks get longer beyond so many.
MOST_WRITE_TASKS = 1_000


def data_directory(path: str, layout: str, run_date: object | None) -> str:
    """Where a layout keeps its files: the path, or a folder in it named by the date."""
    if layout not in (FLAT, DATED):
        raise ValueError(f"unknown layout {layout!r}: use {FLAT!r} or {DATED!r}")
    if layout == FLAT:
        return path.rstrip("/") or path
    if not run_date:
        raise ValueError(f"layout {DATED!r} needs run_date")
    return f"{path.rstrip('/')}/{run_date}"


def column_list(columns: str | Sequence[str] | None) -> list[str]:
    if columns is None:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def parse_day(run_date: object | None) -> dt.date:
    """A day given as a date, ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    if not run_date:
        raise ValueError("writing one day needs run_date")
    return dt.date.fromisoformat(str(run_date))


def write_tasks(rows: int, rows_per_file: int) -> int:
    """Tasks for files of so few rows that their number takes the time, not their bytes."""
    files = -(-rows // rows_per_file)
    return max(1, min(MOST_WRITE_TASKS, -(-files // FILES_PER_TASK)))


def nested_columns(schema: T.StructType) -> list[str]:
    kinds = (T.ArrayType, T.MapType, T.StructType)
    return [field.name for field in schema.fields if isinstance(field.dataType, kinds)]


def reject_nested_csv(file_format: str, schema: T.StructType | None) -> None:
    """csv has no nested values: say so now rather than deep inside a job."""
    nested = nested_columns(schema) if file_format == "csv" and schema is not None else []
    if nested:
        raise ValueError(f"csv cannot hold nested columns {nested}; use parquet, orc or json")


def only_day(data: DataFrame, field: str, day: dt.date) -> DataFrame:
    """The same rows; one of another day, or of none, fails the job before it commits."""
    if not isinstance(data.schema[field].dataType, T.DateType):
        raise ValueError(f"day column {field!r} must be a date")
    found = F.coalesce(F.col(field).cast("string"), F.lit("no day"))
    message = F.concat(F.lit(f"only {day} may be written, found "), found)
    return data.where(F.when(F.col(field) == F.lit(day), True).otherwise(F.raise_error(message)))


def arrange(
    data: DataFrame,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    rebalance: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Distribute and sort rows for the files they go to.

    Cluster columns deal the rows out by range, partition columns first, so that files of a
    folder hold ranges of their own and a reader skips those, and row groups in them, that
    cannot hold what it looks for. A hash of the row comes last among the range keys, so that
    a value with very many rows still spreads over tasks. The bounds take a look at the rows:
    what comes after the last shuffle in front runs twice. ``tasks`` is the number of ranges,
    which adaptive execution otherwise joins by their bytes. Without cluster columns,
    rebalancing brings the rows of a partition folder together, splits a folder that is too
    big for one task and joins small ones. Either is one shuffle; without it every task
    writes a file into each folder it has rows for, sorted by cluster columns in itself.
    """
    if rebalance and cluster_by:
        tie = [field.name for field in data.schema.fields if hashable(field.dataType)]
        keys = [F.col(quoted(name)) for name in (*partition_by, *cluster_by)]
        keys.append(F.xxhash64(*[F.col(quoted(name)) for name in tie]))
        data = data.repartitionByRange(*([tasks] if tasks else []), *keys)
    elif rebalance and partition_by:
        data = data.hint("rebalance", *partition_by)
    if not cluster_by:
        return data
    return data.sortWithinPartitions(*[quoted(name) for name in (*partition_by, *cluster_by)])
