"""Parameter keys of files, kept beside the data so that they are looked for once.

The index is a Parquet folder with one row per (file, its time of change, event name, key),
and one without name and key per file looked at, so that a file without events counts as
known. It grows with files and keys, not with events. A file that was written anew has
another time and is looked at again; rows of files that are gone are not used. Runs only
append, so that two at a time do no harm: rows they both add are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import ITEMS_KEY, PARAMS
from .filters import keep_events

SCHEMA = "file string, changed timestamp, event_name string, key string"
FILE = ["file", "changed"]
#: New files that are named to a scan one by one.
FEW_FILES = 1_000


def files_of(data: DataFrame) -> DataFrame:
    """The files a frame reads and their times of change; no column of them is read."""
    return data.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("changed"),
    ).distinct()


def keys_of_files(data: DataFrame) -> DataFrame:
    """The index rows of all files of a frame, by one scan of the names and keys."""
    rows = data.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("changed"),
        "event_name",
        # A NULL key stands for the file itself.
        F.explode(F.concat(F.array(F.lit(None)), F.coalesce(F.col(f"{PARAMS}.key"), F.array()))).alias("key"),
    )
    name = F.when(F.col("key").isNotNull(), F.col("event_name")).alias("event_name")
    rows = rows.select(*FILE, name, "key").distinct()
    return rows.where("key is null or event_name is not null").where(
        F.col("key").isNull() | (F.col("key") != ITEMS_KEY)
    )


def known_keys(data: DataFrame, index: str) -> DataFrame:
    """The index as it is stored; empty where there is none yet."""
    spark = data.sparkSession
    try:
        return spark.read.schema(SCHEMA).parquet(index)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def update_key_index(data: DataFrame, index: str) -> int:
    """Look for keys in the files that the index lacks, add them, and say how many those are.

    ``data`` reads files directly, as the sources' frames do. A few new files are named to
    the scan, which then opens no others; beyond ``FEW_FILES`` it looks at all.
    """
    known = known_keys(data, index).where("key is null").select(*FILE).distinct()
    missing = files_of(data).join(known, FILE, "left_anti")
    count = missing.count()
    if count:
        chosen = data
        if count <= FEW_FILES:
            paths = [row["file"] for row in missing.collect()]
            chosen = data.where(F.col("_metadata.file_path").isin(paths))
        rows = keys_of_files(chosen).join(known, FILE, "left_anti")
        rows.write.mode("append").parquet(index)
    return count


def indexed_param_keys(
    data: DataFrame,
    index: str,
    max_keys: int | None = None,
    event_name: str | None = None,
    event_list: Sequence[str] | None = None,
    event_pattern: str | None = None,
) -> list[str]:
    """The keys in use by events of these names, sorted, by way of the index."""
    update_key_index(data, index)
    rows = known_keys(data, index).join(files_of(data), FILE, "left_semi").where("key is not null")
    rows = keep_events(rows, event_name, event_list, event_pattern).select("key").distinct()
    found = [row["key"] for row in (rows if max_keys is None else rows.limit(max_keys + 1)).collect()]
    if max_keys is not None and len(found) > max_keys:
        raise ValueError(
            f"more than {max_keys} distinct parameter keys; raise max_keys or name param_keys"
        )
    return sorted(found)
