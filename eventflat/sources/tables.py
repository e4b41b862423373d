"""Catalog tables as source and sink."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.params import quoted
from .evolution import fitted_to, lacking, staged, widen
from .files import Sink, Source, as_it_is
from .layout import arrange, column_list, only_day, parse_day

# Modes of a table write.
BACKFILL = "backfill"
SCHEDULED = "scheduled"


def table_source(table: str | None = None, query: str | None = None) -> Source:
    """A table by name, or the result of a query; exactly one of the two."""
    if bool(table) == bool(query):
        raise ValueError("give exactly one of table and query")

    def read(spark: SparkSession) -> DataFrame:
        return spark.read.table(table) if table else spark.sql(query)

    return read


def table_sink(
    table: str,
    write_mode: str = BACKFILL,
    partition_field: str | None = None,
    cluster_fields: str | Sequence[str] | None = None,
    run_date: object | None = None,
    format: str = "parquet",
    options: dict[str, Any] | None = None,
) -> Sink:
    """Replace a whole table (backfill) or bring it up to date (scheduled).

    A scheduled write replaces the partition of ``run_date`` when the table has a day
    column, and appends when it has none. Scheduled rows are matched to the table by name, in
    nested fields too: absent fields become NULL, and the table gets new ones, old rows with
    NULL. Rows with new fields are staged first, so that a row of another day, or any other
    failure of the rows, leaves the table as it was; where the catalog cannot add fields the
    write is an error that names them. A backfill of a partitioned table is rebalanced by
    day, as it holds many; ``cluster_fields`` deal the rows of a day out by range. ``options`` may name a ``path`` for the files.
    """
    if write_mode not in (BACKFILL, SCHEDULED):
        raise ValueError(f"unknown write_mode {write_mode!r}")
    clusters = column_list(cluster_fields)
    partitions = column_list(partition_field)
    day = parse_day(run_date) if write_mode == SCHEDULED and partitions else None

    def save(data: DataFrame, mode: str, last: Callable[[DataFrame], DataFrame]) -> None:
        spread = write_mode == BACKFILL or bool(clusters)
        writer = last(arrange(data, partitions, clusters, spread)).write.format(format)
        writer = writer.mode(mode).options(**(options or {}))
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.saveAsTable(table)

    def put(rows: DataFrame, last: Callable[[DataFrame], DataFrame]) -> None:
        rows = fitted_to(rows, table)
        if day is None:
            save(rows, "append", last)
        else:
            rows = last(arrange(rows, [], clusters, bool(clusters)))
            _replace_partition(rows, table, partition_field, day)

    def write(data: DataFrame, last: Callable[[DataFrame], DataFrame] = as_it_is) -> None:
        spark = data.sparkSession
        rows = data if day is None else only_day(data, partition_field, day)
        if write_mode == BACKFILL:
            save(data, "overwrite", last)
        elif not spark.catalog.tableExists(table):
            save(rows, "append" if day is None else "overwrite", last)
        elif not lacking(spark, table, rows.schema):
            put(rows, last)
        else:
            with staged(rows, table) as kept:
                widen(spark, table, rows.schema)
                put(kept, last)

    return write


def _replace_partition(rows: DataFrame, table: str, field: str, day: dt.date) -> None:
    """Overwrite one partition with a constant partition value: no other is touched."""
    spark = rows.sparkSession
    names = [name for name in spark.table(table).columns if name != field]
    listed = ", ".join(map(quoted, names))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({quoted(field)} = DATE'{day}') "
        f"SELECT {listed} FROM {{rows}}",
        rows=rows,
    )
