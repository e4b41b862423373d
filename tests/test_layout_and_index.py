"""Clustered files, counts from files, pattern prefixes and the index of parameter keys."""

from __future__ import annotations

import functools
import os
import time

import pytest
from frames import frame, params, plan
from pyspark.sql import functions as F

from checks import storage_queries
from eventflat import file_sink, parquet_sink, parquet_source, run_job, table_sink
from eventflat.operators import discover_param_keys, indexed_param_keys, keep_events
from eventflat.operators import key_index, spread
from eventflat.operators.filters import like_prefix
from eventflat.plans import job
from eventflat.sources.layout import write_tasks


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def files(data, column):
    name = F.col("_metadata.file_path")
    return data.groupBy("day", name.alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n")
    ).orderBy("day", "low", "high").collect()


def by_day(rows):
    found = {}
    for row in rows:
        found.setdefault(row["day"], []).append(row)
    return found


def scattered(spark, rows=4000):
    return spark.range(rows, numPartitions=8).selectExpr(
        "id", "date_add(date'2024-01-01', int(id % 2)) as day", "xxhash64(id) as user", "map('a', id) as m"
    )


def test_files_of_a_day_hold_ranges_of_their_own(small_tasks, tmp_path):
    spark, path = small_tasks, str(tmp_path / "out")
    parquet_sink(path, partition_by="day", cluster_by="user")(scattered(spark))
    days = by_day(files(spark.read.parquet(path), "user"))
    assert len(days) == 2 and spark.read.parquet(path).count() == 4000
    for own in days.values():
        assert len(own) > 2
        assert all(one["high"] <= other["low"] for one, other in zip(own, own[1:], strict=False))


def test_a_value_with_half_of_the_rows_spreads_over_files(small_tasks, tmp_path):
    spark, path = small_tasks, str(tmp_path / "out")
    data = scattered(spark).withColumn("user", F.when(F.col("id") % 4 < 2, F.col("user")))
    parquet_sink(path, partition_by="day", cluster_by="user")(data)
    found = files(spark.read.parquet(path), "user")
    assert max(row["n"] for row in found) < 1000 and sum(row["n"] for row in found) == 4000


def test_without_rebalance_rows_stay_in_their_tasks(small_tasks, tmp_path):
    spark, path = small_tasks, str(tmp_path / "out")
    parquet_sink(path, cluster_by="user", rebalance=False)(scattered(spark))
    assert len(files(spark.read.parquet(path), "user")) == 16


def parts(path):
    """Numbers of the tasks that left a file."""
    names = [name for _, _, found in os.walk(path) for name in found if name.startswith("part-")]
    return {name.split("-")[1] for name in names}, len(names)


def test_tasks_of_a_clustered_write_follow_its_small_files(spark, tmp_path):
    assert [write_tasks(rows, 50) for rows in (0, 1, 5000, 5001, 10**9)] == [1, 1, 1, 2, 1000]
    data, few, many = scattered(spark, 15_000), str(tmp_path / "few"), str(tmp_path / "many")
    small = {"partition_by": "day", "cluster_by": "user", "options": {"maxRecordsPerFile": 50}}
    file_sink(few, **small)(data)
    file_sink(many, **small, cluster_tasks=write_tasks(15_000, 50))(data)
    assert len(parts(few)[0]) < 3 and len(parts(many)[0]) == 3
    assert 300 <= parts(many)[1] <= 304
    written = spark.read.parquet(many)
    assert written.count() == 15_000 and written.select("id").distinct().count() == 15_000
    for own in by_day(files(written, "user")).values():
        assert all(one["high"] <= other["low"] for one, other in zip(own, own[1:], strict=False))
    with pytest.raises(ValueError, match="cluster_tasks"):
        file_sink(many, cluster_tasks=3)


def test_sink_clustered_deals_its_files_out_over_tasks(spark, tmp_path, monkeypatch):
    spark.range(15_000).selectExpr(
        "id as event_id", "timestamp_micros(1704067200000000 + id * 10000000) as ts", "id % 90 as user_id",
        "'view' as event_type", "cast(null as double) as value", "concat('{\"k\": ', id % 100, '}') as props",
    ).coalesce(1).write.parquet(str(tmp_path / "in" / "events.parquet"))
    monkeypatch.setattr(storage_queries, "new_folder", lambda spark: str(tmp_path / "out"))
    days = storage_queries.sink_clustered(spark, str(tmp_path / "in")).collect()
    n_rows = sum(id % 101 != 0 for id in range(15_000))
    assert sum(day["n_rows"] for day in days) == n_rows and len(days) == 2
    assert not any(day["n_overlaps"] for day in days) and all(day["half_skipped"] for day in days)
    assert len(parts(tmp_path / "out")[0]) == 3


def test_clustered_table_day_and_its_report(small_tasks, tmp_path):
    spark, table = small_tasks, f"clustered_{os.getpid()}_{time.time_ns()}"
    table_sink(table, "backfill", "day", "user")(scattered(spark))
    table_sink(table, "scheduled", "day", "user", run_date="2024-01-01")(
        scattered(spark, 3000).where("day = '2024-01-01'")
    )
    days = by_day(files(spark.table(table), "user"))
    assert [sum(row["n"] for row in own) for own in days.values()] == [1500, 2000]
    for own in days.values():
        assert all(one["high"] <= other["low"] for one, other in zip(own, own[1:], strict=False))
    spark.sql(f"DROP TABLE {table}")
    nested = frame(spark, *[{"event_timestamp": i, "event_params": params(("a", i))} for i in range(50)])
    nested.write.parquet(str(tmp_path / "in"))
    report = run_job(spark, {
        "job": "flatten_events", "params": {"event_name": "view"}, "count_input": True,
        "source": {"type": "parquet", "path": str(tmp_path / "in")},
        "sink": {"type": "parquet", "path": str(tmp_path / "flat"), "cluster_by": "event_timestamp"},
    })
    assert (report["rows_read"], report["rows_written"]) == (50, 50)


@pytest.mark.parametrize("kind", ["parquet", "files", "json"])
def test_counted_input_keeps_filters_in_the_scan(spark, tmp_path, kind):
    rows = [{"event_name": n, "event_params": params(("a", 1))} for n in ["view"] * 3 + ["click"] * 4]
    data = frame(spark, *[{**row, "event_timestamp": i} for i, row in enumerate(rows)])
    path = str(tmp_path / "in")
    data.write.format("json" if kind == "json" else "parquet").save(path)
    source = {"type": "files" if kind == "json" else kind, "path": path}
    if kind == "json":
        source |= {"format": "json", "schema": data.schema}
    report = run_job(spark, {
        "job": "flatten_events", "params": {"event_name": "view"}, "count_input": True,
        "source": source, "sink": {"type": "parquet", "path": str(tmp_path / "out")},
    })
    assert (report["rows_read"], report["rows_written"]) == (7, 3)
    read = parquet_source(path)
    if kind != "json":
        assert read.counted_by_files
        assert "PushedFilters: [IsNotNull(event_name), EqualTo(event_name,view)]" in plan(
            keep_events(read(spark), "view")
        )
        assert "ReadSchema: struct<>" in plan(read(spark).groupBy().count())


@pytest.mark.parametrize(
    ("pattern", "prefix"),
    [("purch%", "purch"), ("add_to%", "add"), (r"add\_to%", "add_to"), ("%x", ""), ("_x", ""),
     ("whole", "whole"), (r"a\%b_", "a%b"), (r"\\a%", "\\a")],
)
def test_pattern_prefix_is_pushed(spark, tmp_path_factory, pattern, prefix):
    assert like_prefix(pattern) == prefix
    names = ["purchase", "add_to_cart", "addXtoY", "whole", "a%bc", "\\ab", "x", "ax", None, "ad"]
    path = str(tmp_path_factory.mktemp("names") / "in")
    frame(spark, *[{"event_name": name} for name in names]).write.parquet(path)
    data = spark.read.parquet(path)
    kept = keep_events(data, event_pattern=pattern)
    assert sorted(r[0] for r in kept.select("event_name").collect()) == sorted(
        r[0] for r in data.where(F.col("event_name").like(pattern)).select("event_name").collect()
    )
    if prefix:
        pushed = plan(kept).split("PushedFilters: ")[1].split("]")[0]
        assert f"StringStartsWith(event_name,{prefix})" in pushed or f"EqualTo(event_name,{prefix})" in pushed


def write_file(spark, path, name, *keys):
    row = {"event_name": name, "event_params": params(*[(key, 1) for key in keys])}
    frame(spark, row).coalesce(1).write.mode("append").parquet(path)


def test_key_index(spark, tmp_path, monkeypatch):
    path, index = str(tmp_path / "in"), str(tmp_path / "keys")
    write_file(spark, path, "view", "b", "a", "items")
    write_file(spark, path, "click", "c", None)
    frame(spark, {"event_name": "empty", "event_params": None}).coalesce(1).write.mode("append").parquet(path)

    def keys(**chosen):
        data = parquet_source(path)(spark)
        found = indexed_param_keys(data, index, **chosen)
        assert found == discover_param_keys(keep_events(data, **chosen))
        return found

    assert keys(event_list=["view", "click"]) == ["a", "b", "c"]
    rows = spark.read.parquet(index).count()
    looked = []
    usual = key_index.keys_of_files
    monkeypatch.setattr(key_index, "keys_of_files", lambda data: looked.append(1) or usual(data))
    assert keys(event_name="view") == ["a", "b"]
    assert keys(event_pattern="cl%") == ["c"] and keys(event_name="empty") == []
    assert not looked and spark.read.parquet(index).count() == rows
    write_file(spark, path, "view", "d")
    assert keys(event_name="view") == ["a", "b", "d"] and len(looked) == 1
    # The rows of a file that is gone are not used; a file written anew is looked at again.
    other = str(tmp_path / "other")
    write_file(spark, other, "view", "z")
    assert indexed_param_keys(parquet_source(other)(spark), index, event_name="view") == ["z"]
    assert keys(event_name="view") == ["a", "b", "d"]
    monkeypatch.setattr(key_index, "FEW_FILES", 0)
    write_file(spark, path, "view", "e")
    assert keys(event_name="view") == ["a", "b", "d", "e"]
    with pytest.raises(ValueError):
        indexed_param_keys(parquet_source(path)(spark), index, 2, event_name="view")


def test_named_files_are_the_only_ones_scanned(spark, tmp_path):
    path, index = str(tmp_path / "in"), str(tmp_path / "keys")
    for key in "abc":
        write_file(spark, path, "view", key)
    data = parquet_source(path)(spark)
    assert key_index.update_key_index(data, index) == 3
    assert key_index.update_key_index(data, index) == 0
    one = key_index.files_of(data).first()["file"]
    scan = data.where(F.col("_metadata.file_path").isin([one]))
    assert {row[0] for row in key_index.keys_of_files(scan).select("file").collect()} == {one}


@pytest.mark.parametrize("copies", [1, 40])
def test_a_large_row_group_is_spread_before_the_merge(spark, tmp_path, monkeypatch, copies):
    path = str(tmp_path / "in")
    rows = [
        {"event_name": "view" if i % 4 else "click", "event_timestamp": i // copies,
         "event_params": params(("a", i // copies), ("b", "x"))} for i in range(4000)
    ]
    frame(spark, *rows).coalesce(1).write.parquet(path)
    flatten, has_rows = job.JOBS["flatten_events"]
    most = []

    @functools.wraps(flatten)
    def noted(data, **given):
        most.append(max(row["count"] for row in spread.rows_by_task(data).collect()))
        return flatten(data, **given)

    def written(name, **more):
        report = run_job(spark, {
            "job": "flatten_events", "params": {"event_list": ["view"], **more},
            "source": {"type": "parquet", "path": path},
            "sink": {"type": "parquet", "path": str(tmp_path / name)},
        })
        found = spark.read.parquet(str(tmp_path / name))
        return report["rows_written"], sorted(map(str, found.collect()))

    monkeypatch.setitem(job.JOBS, "flatten_events", (noted, has_rows))
    whole = written("whole")
    monkeypatch.setattr(spread, "LARGE_TASK", 1000)
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 500)
    assert written("spread") == whole
    # Rows of one file are dealt out by a hash: no task has much more than its share.
    assert most[0] == 3000 and most[1] < 600
    assert written("chosen", num_partitions=2) == whole and most[2] == 4000
