"""Sources, sinks and the runner (X-23 and X-24 of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from frames import frame, params, plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

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

SESSION = ("ga_session_id", 7)
NESTED = T.StructType().add("a", "string").add("b", T.ArrayType(T.IntegerType()))


def nested(spark):
    return frame(
        spark,
        *[
            {
                "event_timestamp": day * 10 + place,
                "event_date": f"2024010{day}",
                "event_params": params(SESSION, ("page_location", f"{day}-{place}")),
            }
            for day in (1, 2, 3)
            for place in (1, 2)
        ],
    )


def pages(flat) -> list[str]:
    return sorted(row[0] for row in flat.select("event_params.page_location").collect())


def test_arguments_are_checked_at_once(tmp_path):
    with pytest.raises(ValueError, match="layout"):
        parquet_source("x", layout="hourly")
    with pytest.raises(ValueError, match="run_date"):
        parquet_source("x", layout="date_partitioned")
    with pytest.raises(ValueError, match="run_date"):
        file_source("x", layout="date_partitioned")
    with pytest.raises(ValueError, match="exactly one"):
        table_source()
    with pytest.raises(ValueError, match="exactly one"):
        table_source(table="t", query="SELECT 1")
    with pytest.raises(ValueError, match="write_mode"):
        table_sink("t", write_mode="daily")
    with pytest.raises(ValueError, match="run_date"):
        table_sink("t", write_mode="scheduled", partition_field="event_date")
    with pytest.raises(ValueError, match="run_date"):
        parquet_sink("x", "overwrite_day", "event_date")
    with pytest.raises(ValueError, match="partition_by"):
        parquet_sink("x", "overwrite_day", run_date="2024-01-02")
    with pytest.raises(ValueError, match="csv"):
        file_source("x", format="CSV", schema=NESTED)


def test_csv_source_rejects_nested_ddl(spark):
    source = file_source("x", format="csv", schema="a string, b array<int>")
    with pytest.raises(ValueError, match="csv"):
        source(spark)


def test_csv_sink_rejects_nested_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="event_params"):
        file_sink(str(tmp_path / "out"), format="csv")(nested(spark))


def test_flat_layout_takes_only_parquet_of_the_folder(spark, tmp_path):
    nested(spark).write.parquet(str(tmp_path / "data"))
    nested(spark).write.parquet(str(tmp_path / "data" / "2024-01-02"))
    assert parquet_source(str(tmp_path / "data"))(spark).count() == 6
    assert parquet_source(f"{tmp_path}/data/")(spark).count() == 6
    dated = parquet_source(
        str(tmp_path / "data"), run_date=dt.date(2024, 1, 2), layout="date_partitioned"
    )
    assert dated(spark).count() == 6


def test_partition_filter_prunes_folders(spark, tmp_path):
    nested(spark).write.partitionBy("event_date").parquet(str(tmp_path / "data"))
    data = file_source(str(tmp_path / "data"), where=F.col("event_date") == 20240102)(spark)
    assert data.count() == 2
    assert "PartitionFilters: [isnotnull(event_date" in plan(data)


@pytest.mark.parametrize("run_date", ["2024-01-02", "20240102", dt.date(2024, 1, 2)])
def test_x23_day_overwrite_of_files(spark, tmp_path, run_date):
    out = str(tmp_path / "out")
    flat = flatten_events(nested(spark), "view")
    parquet_sink(out, partition_by="event_date")(flat)
    new_day = flat.where("event_date = '2024-01-02' and event_timestamp = 21")
    parquet_sink(out, "overwrite_day", "event_date", run_date=run_date)(new_day)
    assert pages(spark.read.parquet(out)) == ["1-1", "1-2", "2-1", "3-1", "3-2"]


def test_day_overwrite_refuses_other_days(spark, tmp_path):
    out = str(tmp_path / "out")
    flat = flatten_events(nested(spark), "view")
    parquet_sink(out, partition_by="event_date")(flat)
    sink = parquet_sink(out, "overwrite_day", "event_date", run_date="2024-01-02")
    with pytest.raises(Exception, match="only 2024-01-02 may be written"):
        sink(flat)
    no_day = flat.withColumn("event_date", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="found no day"):
        sink(no_day)
    with pytest.raises(ValueError, match="must be a date"):
        sink(flat.withColumn("event_date", F.lit("2024-01-02")))
    assert pages(spark.read.parquet(out)) == ["1-1", "1-2", "2-1", "2-2", "3-1", "3-2"]


def test_day_overwrite_of_a_table(spark):
    flat = flatten_events(nested(spark), "view")
    spark.sql("DROP TABLE IF EXISTS flat_days")
    scheduled = table_sink(
        "flat_days", "scheduled", "event_date", "event_timestamp", run_date="2024-01-02"
    )
    scheduled(flat.where("event_date = '2024-01-02'"))
    assert pages(spark.table("flat_days")) == ["2-1", "2-2"]
    table_sink("flat_days", "backfill", "event_date", "event_timestamp")(flat)
    scheduled(flat.where("event_timestamp = 21").select(*reversed(flat.columns)))
    assert pages(spark.table("flat_days")) == ["1-1", "1-2", "2-1", "3-1", "3-2"]
    with pytest.raises(Exception, match="only 2024-01-02 may be written"):
        scheduled(flat)
    assert spark.table("flat_days").count() == 5


def test_table_append_and_replace(spark):
    flat = flatten_events(nested(spark), "view")
    spark.sql("DROP TABLE IF EXISTS flat_all")
    append = table_sink("flat_all", "scheduled")
    append(flat)
    append(flat)
    assert spark.table("flat_all").count() == 12
    table_sink("flat_all")(flat)
    assert spark.table("flat_all").count() == 6
    assert table_source(query="SELECT * FROM flat_all LIMIT 1")(spark).count() == 1


def test_x24_runs_with_different_keys(spark, tmp_path):
    out = str(tmp_path / "out")
    for key in ("a", "b"):
        events = frame(spark, {"event_name": key, "event_params": params((key, "1"))})
        parquet_sink(out, mode="append")(flatten_events(events, key))
    united = parquet_source(out, options={"mergeSchema": "true"})(spark)
    found = {
        row["event_name"]: row["event_params"].asDict() for row in united.collect()
    }
    assert found == {"a": {"a": "1", "b": None}, "b": {"a": None, "b": "1"}}


def test_rebalanced_write_leaves_few_files(spark, tmp_path):
    flat = flatten_events(nested(spark), "view").repartition(6)
    for rebalance, most in ((False, 6), (True, 3)):
        out = str(tmp_path / f"out-{rebalance}")
        parquet_sink(
            out, partition_by="event_date", cluster_by="event_timestamp", rebalance=rebalance
        )(flat)
        assert 3 <= len(glob.glob(f"{out}/event_date=*/*.parquet")) <= most
        assert spark.read.parquet(out).count() == 6


def job(tmp_path, **changes) -> dict:
    return {
        "job": "flatten_events",
        "run_date": "2024-01-02",
        "params": {"event_name": "view"},
        "source": {
            "type": "parquet", "path": str(tmp_path / "in"), "layout": "date_partitioned"
        },
        "sink": {"type": "parquet", "path": str(tmp_path / "out")},
        **changes,
    }


def test_runner_reports_and_writes(spark, tmp_path):
    nested(spark).write.parquet(str(tmp_path / "in" / "2024-01-02"))
    report = run_job(spark, job(tmp_path, count_input=True))
    assert report == {
        "job": "flatten_events", "written": True, "rows_written": 6, "rows_read": 6,
    }
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    sessions = job(
        tmp_path,
        job="flatten_sessions",
        params={},
        sink={"type": "files", "path": str(tmp_path / "sessions"), "format": "json"},
        run_date=dt.date(2024, 1, 2),
    )
    assert run_job(spark, sessions)["rows_written"] == 3


@pytest.mark.parametrize(
    "params",
    [
        {"event_name": "absent"},
        {"event_name": "view", "event_type": "ecommerce"},
        {"event_name": "absent", "param_keys": ["a"]},
    ],
)
def test_runner_skips_an_empty_write(spark, tmp_path, params):
    nested(spark).write.parquet(str(tmp_path / "in" / "2024-01-02"))
    report = run_job(spark, job(tmp_path, params=params))
    assert report["written"] is False
    assert not (tmp_path / "out").exists()


def test_runner_skips_when_no_session(spark, tmp_path):
    frame(spark, {"event_params": params(("a", "1"))}).write.parquet(
        str(tmp_path / "in" / "2024-01-02")
    )
    assert run_job(spark, job(tmp_path, job="flatten_sessions", params={}))["written"] is False


def test_runner_checks_the_whole_spec_first(spark, tmp_path):
    for changes, message in [
        ({"job": "flatten_pages"}, "unknown job"),
        ({"source": {"type": "ftp"}}, "unknown source type"),
        ({"sink": {}}, "unknown sink type"),
        ({"params": {"event_nam": "x"}}, "event_nam"),
        ({"run_date": None}, "needs run_date"),
    ]:
        with pytest.raises(ValueError, match=message):
            run_job(spark, job(tmp_path, **changes))
    with pytest.raises(TypeError):
        run_job(spark, job(tmp_path, sink={"type": "parquet", "path": "x", "colour": "red"}))
