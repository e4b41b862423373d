"""Spread rows of a Parquet source whose tasks would have too many of them at once.

A task reads a row group whole, into however many splits the file is cut, and the merge of
equal events sorts what its task has. So the memory of a task would follow the rows of a row
group, and the rest of the cluster would be idle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task may have before all are spread.
LARGE_TASK = 250_000
#: Rows of a task once they are spread.
ROWS_PER_TASK = 100_000
#: Up to so many tasks Spark's shuffle writes rows to a file each and holds none in memory.
MOST_TASKS = 200


def rows_by_task(data: DataFrame) -> DataFrame:
    """The number of rows in each task that has any; no column of a Parquet file is read."""
    return data.select(F.spark_partition_id().alias("task")).groupBy("task").count()


def spread_large_tasks(data: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``kept``, a filter of ``data``, over more tasks if one of ``data`` is large.

    ``data`` reads Parquet files directly. Rows go by their file and place in it: copies of a
    row spread like others, nothing is sorted for it, and a task that runs again deals them
    out alike.
    """
    found = rows_by_task(data).agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    if (found["most"] or 0) <= LARGE_TASK:
        return kept
    tasks = min(MOST_TASKS, -(-found["all"] // ROWS_PER_TASK))
    name = "_place" + "_" * max(map(len, kept.columns))  # Longer than any: no column's name.
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return kept.withColumn(name, place).repartition(tasks, name).drop(name)
