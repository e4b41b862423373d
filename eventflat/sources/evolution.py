"""Tables whose rows get new fields: which are new, how the table gets them, rows in its form.

A top-level column is added by ``ALTER TABLE``. The built-in catalog cannot add a field to a
struct in that way; there the table is registered anew with the wider schema. Either is a
change of the catalog only: files stay as they are, and old rows read NULL for new fields.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.params import quoted

#: Name of the built-in catalog.
BUILT_IN = "spark_catalog"


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


def _by_name(schema: T.StructType, exact: bool) -> dict[str, T.StructField]:
    return {field.name if exact else field.name.lower(): field for field in schema.fields}


def new_fields(
    source: T.DataType, target: T.DataType, exact: bool = False, path: str = ""
) -> list[tuple[str, T.DataType]]:
    """Fields of the source, nested ones too, that the target lacks: SQL path and type."""
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return new_fields(source.elementType, target.elementType, exact, f"{path}element.")
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return new_fields(source.valueType, target.valueType, exact, f"{path}value.")
    if not (isinstance(source, T.StructType) and isinstance(target, T.StructType)):
        return []
    known, found = _by_name(target, exact), []
    for name, field in _by_name(source, exact).items():
        own = path + quoted(field.name)
        if name not in known:
            found.append((own, field.dataType))
        else:
            found += new_fields(field.dataType, known[name].dataType, exact, own + ".")
    return found


def widened(target: T.DataType, source: T.DataType, exact: bool = False) -> T.DataType:
    """The target's type with the fields it lacks, nullable, at the end of their struct."""
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        inner = widened(target.elementType, source.elementType, exact)
        return T.ArrayType(inner, target.containsNull)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        inner = widened(target.valueType, source.valueType, exact)
        return T.MapType(target.keyType, inner, target.valueContainsNull)
    if not (isinstance(source, T.StructType) and isinstance(target, T.StructType)):
        return target
    given, known = _by_name(source, exact), _by_name(target, exact)
    fields = []
    for name, field in known.items():
        kind = widened(field.dataType, given[name].dataType, exact) if name in given else field.dataType
        fields.append(T.StructField(field.name, kind, field.nullable, field.metadata))
    fields += [
        T.StructField(field.name, field.dataType) for name, field in given.items() if name not in known
    ]
    return T.StructType(fields)


def type_text(kind: T.DataType) -> str:
    """A type as SQL text, with field names quoted."""
    if isinstance(kind, T.StructType):
        inner = ", ".join(f"{quoted(f.name)}: {type_text(f.dataType)}" for f in kind.fields)
        return f"struct<{inner}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{type_text(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{type_text(kind.keyType)}, {type_text(kind.valueType)}>"
    return kind.simpleString()


def matched(value: Column, source: T.DataType, target: T.DataType, exact: bool) -> Column:
    """The value in the target's type, struct fields by name and NULL where it has none."""
    if source == target:
        return value
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        inner, outer = source.elementType, target.elementType
        return F.transform(value, lambda item: matched(item, inner, outer, exact))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        inner, outer = source.valueType, target.valueType
        return F.transform_values(value, lambda _, item: matched(item, inner, outer, exact))
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        known = _by_name(source, exact)
        fields = []
        for name, field in _by_name(target, exact).items():
            if name in known:
                own = value.getField(known[name].name)
                own = matched(own, known[name].dataType, field.dataType, exact)
            else:
                own = F.lit(None).cast(field.dataType)
            fields.append(own.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(target)


def fitted_to(data: DataFrame, table: str) -> DataFrame:
    """The rows in the table's columns, by name; the table has all their fields."""
    spark = data.sparkSession
    exact = case_sensitive(spark)
    source, columns = _by_name(data.schema, exact), []
    for name, field in _by_name(spark.table(table).schema, exact).items():
        if name in source:
            own = source[name]
            value = matched(data[quoted(own.name)], own.dataType, field.dataType, exact)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return data.select(*columns)


def lacking(spark: SparkSession, table: str, schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """Fields of the schema that the table has not got: SQL path and type."""
    return new_fields(schema, spark.table(table).schema, case_sensitive(spark))


def widen(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give the table all fields of the schema, in its catalog only."""
    missing = lacking(spark, table, schema)
    if not missing:
        return
    columns = ", ".join(f"{path} {type_text(kind)}" for path, kind in missing)
    try:
        if spark.catalog.getTable(table).catalog in (BUILT_IN, None):
            register_anew(spark, table, schema)
        else:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    except (PySparkException, NotImplementedError) as error:
        names = [path.replace("`", "") for path, _ in missing]
        raise ValueError(
            f"table {table} lacks the fields {names} and its catalog cannot add them"
        ) from error


def register_anew(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Swap the schema that the built-in catalog holds for a table; nothing else changes.

    Its own interface for this is no part of the Python API, so the session's is called.
    """
    session = getattr(spark, "_jsparkSession", None)
    if session is None:
        raise NotImplementedError("a remote session reaches no catalog interface")
    partitions = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    wide = widened(spark.table(table).schema, schema, case_sensitive(spark))
    own = T.StructType([field for field in wide.fields if field.name not in partitions])
    state = session.sessionState()
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(own.json())
    state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(table), kind)
    spark.catalog.refreshTable(table)


@contextmanager
def staged(data: DataFrame, beside: str) -> Iterator[DataFrame]:
    """The same rows, written to a table of their own next to another; gone afterwards."""
    spark = data.sparkSession
    *parents, name = _parts(beside)
    own = ".".join([*parents, quoted(f"{name.strip('`')}_staged_{uuid.uuid4().hex}")])
    try:
        data.write.format("parquet").saveAsTable(own)
        yield spark.table(own)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {own}")


def _parts(table: str) -> list[str]:
    """The parts of a table's name, quotes kept; dots inside quotes do not part it."""
    found, quoting = [""], False
    for letter in table:
        quoting ^= letter == "`"
        if letter == "." and not quoting:
            found.append("")
        else:
            found[-1] += letter
    return found
