"""Columns an older export may lack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.fields import BATCH_COLUMNS, default_traffic_columns


def has_column(data: DataFrame, name: str) -> bool:
    """Whether there is such a column, by the session's rule for case."""
    if data.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return name in data.columns
    return name.lower() in {column.lower() for column in data.columns}


def hashable(kind: T.DataType) -> bool:
    """Whether Spark can hash values of this type."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(field.dataType) for field in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def add_missing(data: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Add the columns that are absent; a column that is there keeps its NULLs."""
    missing = [
        f"{value} as {name}" for name, value in defaults.items() if not has_column(data, name)
    ]
    return data.selectExpr("*", *missing) if missing else data


def with_batch_defaults(data: DataFrame) -> DataFrame:
    return add_missing(data, dict.fromkeys(BATCH_COLUMNS, "0L"))


def with_traffic_defaults(data: DataFrame) -> DataFrame:
    return add_missing(data, default_traffic_columns())
