"""File sources and sinks: parquet, or any format Spark knows.

Each function checks its arguments and returns the reader or writer itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from .layout import (
    FLAT,
    arrange,
    column_list,
    data_directory,
    only_day,
    parse_day,
    reject_nested_csv,
)

Source = Callable[[SparkSession], DataFrame]
#: Writes a frame; a second argument is applied to the rows just before they are written.
Sink = Callable[..., None]

OVERWRITE_DAY = "overwrite_day"

#: Formats whose files tell their number of rows, so that a count reads no column.
COUNTED_FORMATS = ("parquet", "orc")
#: Formats whose readers tell a row's place in its file.
NUMBERED_FORMATS = ("parquet",)


def as_it_is(data: DataFrame) -> DataFrame:
    return data


def parquet_source(
    path: str,
    run_date: object | None = None,
    layout: str = FLAT,
    schema: T.StructType | str | None = None,
    options: dict[str, Any] | None = None,
    where: Column | str | None = None,
) -> Source:
    """Parquet files directly in ``path``, or in its folder of one date.

    ``options={"mergeSchema": "true"}`` unites files whose parameter structs differ.
    """
    location = f"{data_directory(path, layout, run_date)}/*parquet"
    return _file_source("parquet", location, schema, options, where)


def file_source(
    path: str | None = None,
    run_date: object | None = None,
    layout: str = FLAT,
    format: str = "parquet",
    options: dict[str, Any] | None = None,
    schema: T.StructType | str | None = None,
    where: Column | str | None = None,
) -> Source:
    """Any format at ``path``, or in its folder of one date.

    Give json a ``schema``: an inferred one costs a scan and reorders struct fields.
    ``where`` on a partition column prunes folders.
    """
    file_format = format.lower()
    if isinstance(schema, T.StructType):
        reject_nested_csv(file_format, schema)
    location = None if path is None else data_directory(path, layout, run_date)
    return _file_source(file_format, location, schema, options, where)


def _file_source(
    file_format: str,
    location: str | None,
    schema: T.StructType | str | None,
    options: dict[str, Any] | None,
    where: Column | str | None,
) -> Source:
    def read(spark: SparkSession) -> DataFrame:
        reader = spark.read.format(file_format).options(**(options or {}))
        if isinstance(schema, str):
            reject_nested_csv(file_format, T.StructType.fromDDL(schema))
        if schema is not None:
            reader = reader.schema(schema)
        data = reader.load(location) if location is not None else reader.load()
        return data if where is None else data.where(where)

    read.counted_by_files = file_format in COUNTED_FORMATS
    read.rows_numbered = file_format in NUMBERED_FORMATS
    return read


def parquet_sink(
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    cluster_by: str | Sequence[str] | None = None,
    run_date: object | None = None,
    rebalance: bool = True,
) -> Sink:
    """Parquet files; see ``file_sink``."""
    return file_sink(
        path, mode, partition_by, "parquet", None, cluster_by, run_date, rebalance
    )


def file_sink(
    path: str | None = None,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    format: str = "parquet",
    options: dict[str, Any] | None = None,
    cluster_by: str | Sequence[str] | None = None,
    run_date: object | None = None,
    rebalance: bool = True,
    cluster_tasks: int | None = None,
) -> Sink:
    """Files under ``path``, optionally one folder per value of the partition columns.

    Mode ``overwrite_day`` replaces the folder of ``run_date`` only; the first partition
    column is then the day. Other modes are Spark's. A partitioned write is rebalanced by one
    shuffle, one with ``cluster_by`` deals rows out by range of those columns; without
    ``rebalance`` every task leaves a file per folder. Adaptive execution makes few tasks of
    few bytes, however many files they have to write: ``cluster_tasks`` sets their number
    for small files (``write_tasks`` has one).
    """
    file_format = format.lower()
    partitions, clusters = column_list(partition_by), column_list(cluster_by)
    if cluster_tasks is not None and not (clusters and rebalance):
        raise ValueError("cluster_tasks needs cluster_by and rebalance")
    day = None
    if mode == OVERWRITE_DAY:
        if not partitions:
            raise ValueError(f"mode {OVERWRITE_DAY!r} needs partition_by")
        day = parse_day(run_date)

    def write(data: DataFrame, last: Callable[[DataFrame], DataFrame] = as_it_is) -> None:
        reject_nested_csv(file_format, data.schema)
        if day is not None:
            data = only_day(data, partitions[0], day)
        writer = last(arrange(data, partitions, clusters, rebalance, cluster_tasks)).write.format(file_format)
        writer = writer.options(**(options or {}))
        if day is not None:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode(mode)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.save(path)

    return write
