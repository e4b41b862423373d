"""Queries that write nested events or flat rows to a new folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventflat import (
    file_sink,
    file_source,
    flatten_events,
    parquet_sink,
    parquet_source,
    run_job,
    table_sink,
    table_source,
)
from eventflat.fixture import load_nested_events
from eventflat.sources.layout import write_tasks

from .event_queries import ALL_NAMES, flat_scalars
from .scratch import new_folder, new_table
from .session_queries import session_scalars

DAY = "2024-01-15"


def _summary(nested: DataFrame) -> DataFrame:
    return nested.select(
        F.col("event_bundle_sequence_id").alias("event_id"),
        "event_name",
        "event_timestamp",
        F.size("event_params").cast("long").alias("param_count"),
        F.col("geo.country").alias("country"),
    )


def source_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    load_nested_events(spark, sf_dir).write.parquet(folder)
    return _summary(parquet_source(folder)(spark))


def source_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    load_nested_events(spark, sf_dir).write.parquet(f"{folder}/{DAY}")
    return _summary(parquet_source(folder, run_date=DAY, layout="date_partitioned")(spark))


def source_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    load_nested_events(spark, sf_dir).write.orc(f"{folder}/{DAY}")
    source = file_source(folder, run_date=DAY, layout="date_partitioned", format="ORC")
    return _summary(source(spark))


def source_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    nested = load_nested_events(spark, sf_dir)
    nested.write.json(folder)
    return _summary(file_source(folder, format="json", schema=nested.schema)(spark))


def source_partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    load_nested_events(spark, sf_dir).write.partitionBy("event_name").parquet(folder)
    return _summary(file_source(folder, where="event_name = 'view'")(spark))


def _nested_table(spark: SparkSession, sf_dir: str) -> str:
    table = new_table()
    sink = table_sink(table, options={"path": new_folder(spark)})
    sink(load_nested_events(spark, sf_dir))
    return table


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(table_source(table=_nested_table(spark, sf_dir))(spark))


def source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _nested_table(spark, sf_dir)
    query = f"SELECT * FROM {table} WHERE event_name = 'view'"
    return _summary(table_source(query=query)(spark))


def _marked(spark: SparkSession, sf_dir: str, mark: str) -> DataFrame:
    """Flattened events of all names with a mark that tells two writes apart."""
    nested = load_nested_events(spark, sf_dir).withColumn("mark", F.lit(mark))
    return flatten_events(
        nested, event_list=ALL_NAMES, additional_columns_to_select=["mark"]
    )


def _marks(flat: DataFrame) -> DataFrame:
    return flat.select(
        "event_timestamp",
        "event_name",
        F.col("event_date").cast("string").alias("event_date"),
        "event_params.page_location",
        "mark",
    )


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    sink = parquet_sink(
        folder, partition_by=["event_date", "event_name"], cluster_by="user_pseudo_id"
    )
    sink(_marked(spark, sf_dir, "first"))
    return _marks(spark.read.parquet(folder))


def sink_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    sink = file_sink(folder, format="orc", options={"compression": "zlib"})
    sink(_marked(spark, sf_dir, "first"))
    return _marks(spark.read.orc(folder))


def sink_day_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    parquet_sink(folder, partition_by="event_date")(_marked(spark, sf_dir, "first"))
    day_sink = parquet_sink(folder, "overwrite_day", "event_date", run_date=DAY)
    day_sink(_marked(spark, sf_dir, "second").where(F.col("event_date") == F.lit(DAY)))
    return _marks(spark.read.parquet(folder))


def sink_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, options = new_table(), {"path": new_folder(spark)}
    for mark in ("first", "second"):
        table_sink(table, options=options)(_marked(spark, sf_dir, mark))
    return _marks(spark.read.table(table))


def sink_table_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, options = new_table(), {"path": new_folder(spark)}
    table_sink(table, "backfill", "event_date", "user_pseudo_id", options=options)(
        _marked(spark, sf_dir, "first")
    )
    day_sink = table_sink(table, "scheduled", "event_date", "user_pseudo_id", run_date=DAY)
    day_sink(_marked(spark, sf_dir, "second").where(F.col("event_date") == F.lit(DAY)))
    return _marks(spark.read.table(table))


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, options = new_table(), {"path": new_folder(spark)}
    for mark in ("first", "second"):
        table_sink(table, "scheduled", options=options)(_marked(spark, sf_dir, mark))
    return _marks(spark.read.table(table))


def sink_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases have a parameter that clicks lack; one read unites both."""
    folder = new_folder(spark)
    nested = load_nested_events(spark, sf_dir)
    for name in ("click", "purchase"):
        parquet_sink(folder, mode="append")(flatten_events(nested, name))
    united = parquet_source(folder, options={"mergeSchema": "true"})(spark)
    return united.select(
        "event_timestamp", "event_name", "event_params.page_location", "event_params.value"
    )


def sink_table_append_new_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks first, then purchases, whose struct has one more field."""
    table, options = new_table(), {"path": new_folder(spark)}
    nested = load_nested_events(spark, sf_dir)
    for name in ("click", "purchase"):
        table_sink(table, "scheduled", options=options)(flatten_events(nested, name))
    return spark.read.table(table).select(
        "event_timestamp", "event_name", "event_params.page_location", "event_params.value"
    )


def sink_table_day_other_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is replaced by rows whose struct lacks a field, has others and another order."""
    table = new_table()
    marked = load_nested_events(spark, sf_dir).withColumns({"mark": F.lit("first")})

    def flat(keys: list[str], *extras: str) -> DataFrame:
        extras = ["mark", *extras]
        return flatten_events(
            marked, event_list=ALL_NAMES, additional_columns_to_select=extras, param_keys=keys
        )

    first = flat(["page_location", "page_referrer"])
    table_sink(table, "backfill", "event_date", options={"path": new_folder(spark)})(first)
    marked = marked.withColumns({"mark": F.lit("second")})
    second = flat(["value", "page_location"], "platform").where(F.col("event_date") == F.lit(DAY))
    table_sink(table, "scheduled", "event_date", run_date=DAY)(second)
    return spark.read.table(table).select(
        "event_timestamp",
        "event_name",
        F.col("event_date").cast("string").alias("event_date"),
        "event_params.page_location",
        "event_params.page_referrer",
        "event_params.value",
        "mark",
        "platform",
    )


def sink_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: rows, files whose range of times overlaps another's, whether a look-up of one
    time may skip at least half of the rows."""
    folder, nested = new_folder(spark), load_nested_events(spark, sf_dir)
    flat = flatten_events(nested, event_list=ALL_NAMES, param_keys=["page_location"])
    # No more rows than events, whose number the file's footer tells.
    n_events, rows_per_file = spark.read.parquet(f"{sf_dir}/events.parquet").count(), 50
    with_small_files = file_sink(
        f"{folder}/small", "overwrite", "event_date",
        # Tasks move their own files: the driver would move them one by one. A run that fails
        # may leave some of them, in a folder that is this run's alone.
        options={"maxRecordsPerFile": rows_per_file, "mapreduce.fileoutputcommitter.algorithm.version": 2},
        cluster_by="event_timestamp", cluster_tasks=write_tasks(n_events, rows_per_file),
    )
    with_small_files(flat)
    files = (
        spark.read.parquet(f"{folder}/small")
        .groupBy("event_date", F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_timestamp").alias("low"), F.max("event_timestamp").alias("high"))
    )
    before = F.max("high").over(
        Window.partitionBy("event_date").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    )
    probe = F.max("low").over(Window.partitionBy("event_date"))
    marked = files.select("*", (before > F.col("low")).alias("overlaps"), probe.alias("probe"))
    skipped = F.sum(F.when((F.col("low") > F.col("probe")) | (F.col("high") < F.col("probe")), F.col("n")).otherwise(0))
    return marked.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.sum("n").alias("n_rows"),
        F.count_if("overlaps").alias("n_overlaps"),
        (2 * skipped >= F.sum("n")).alias("half_skipped"),
    )


def _job(spark: SparkSession, sf_dir: str, job: str, params: dict, **more) -> tuple[dict, str]:
    folder = new_folder(spark)
    load_nested_events(spark, sf_dir).write.parquet(f"{folder}/in/{DAY}")
    report = run_job(
        spark,
        {
            "job": job,
            "run_date": DAY,
            "params": params,
            "source": {
                "type": "parquet", "path": f"{folder}/in", "layout": "date_partitioned"
            },
            "sink": {"type": "files", "path": f"{folder}/out"},
            **more,
        },
    )
    return report, f"{folder}/out"


def run_job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {"event_name": "purchase", "event_type": "ecommerce"}
    _, out = _job(spark, sf_dir, "flatten_events", params)
    return flat_scalars(spark.read.parquet(out))


def run_job_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, out = _job(spark, sf_dir, "flatten_sessions", {})
    return session_scalars(spark.read.parquet(out))


def run_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = _job(
        spark, sf_dir, "flatten_events", {"event_name": "purchase"}, count_input=True
    )
    counts = [(report["rows_read"], report["rows_written"])]
    return spark.createDataFrame(counts, "rows_read long, rows_written long")


def run_job_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No event of that name: nothing is written, and the report says so."""
    report, _ = _job(spark, sf_dir, "flatten_events", {"event_name": "nothing"})
    found = [(report["written"], report["rows_written"])]
    return spark.createDataFrame(found, "written boolean, rows_written long")


def run_job_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files, the second after the first run: the index tells the keys of both."""
    folder = new_folder(spark)
    nested = load_nested_events(spark, sf_dir)
    found = []
    for number, name in enumerate(["click", "purchase"]):
        nested.where(F.col("event_name") == name).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        report = run_job(
            spark,
            {
                "job": "flatten_events",
                "params": {"event_list": ALL_NAMES},
                "key_index": f"{folder}/keys",
                "source": {"type": "parquet", "path": f"{folder}/in"},
                "sink": {"type": "parquet", "path": f"{folder}/out{number}"},
            },
        )
        names = spark.read.parquet(f"{folder}/out{number}").schema["event_params"].dataType.names
        found.append((number, report["rows_written"], ",".join(names)))
    return spark.createDataFrame(found, "run long, rows_written long, keys string")


QUERIES = {
    "source_flat": source_flat,
    "source_dated": source_dated,
    "source_orc": source_orc,
    "source_json_schema": source_json_schema,
    "source_partition_filter": source_partition_filter,
    "source_table": source_table,
    "source_query": source_query,
    "sink_partitioned": sink_partitioned,
    "sink_orc": sink_orc,
    "sink_day_overwrite": sink_day_overwrite,
    "sink_table_replace": sink_table_replace,
    "sink_table_day": sink_table_day,
    "sink_append": sink_append,
    "sink_schema_merge": sink_schema_merge,
    "sink_clustered": sink_clustered,
    "sink_table_append_new_key": sink_table_append_new_key,
    "sink_table_day_other_keys": sink_table_day_other_keys,
    "run_job_events": run_job_events,
    "run_job_sessions": run_job_sessions,
    "run_job_counts": run_job_counts,
    "run_job_empty": run_job_empty,
    "run_job_key_index": run_job_key_index,
}
