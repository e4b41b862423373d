"""One runner: read, transform, write, as told by a plain dictionary."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import keep_events
from ..operators.key_index import indexed_param_keys
from ..operators.params import discover_param_keys
from ..operators.spread import spread_large_tasks
from ..sources import (
    file_sink,
    file_source,
    parquet_sink,
    parquet_source,
    table_sink,
    table_source,
)
from .events import ECOMMERCE, flatten_events, has_events_to_flatten
from .sessions import flatten_sessions, has_sessions

SOURCES = {"parquet": parquet_source, "files": file_source, "table": table_source}
SINKS = {"parquet": parquet_sink, "files": file_sink, "table": table_sink}
JOBS = {
    "flatten_events": (flatten_events, has_events_to_flatten),
    "flatten_sessions": (flatten_sessions, has_sessions),
}

# Parameters that choose events.
SELECTORS = ("event_name", "event_list", "event_pattern")


def _backend(kinds: dict[str, Callable], spec: dict[str, Any], role: str, run_date: str | None):
    entry = dict(spec.get(role) or {})
    kind = entry.pop("type", None)
    if kind not in kinds:
        raise ValueError(f"unknown {role} type {kind!r}: use one of {sorted(kinds)}")
    if run_date is not None and "run_date" in inspect.signature(kinds[kind]).parameters:
        entry.setdefault("run_date", run_date)
    return kinds[kind](**entry)


def _known(function: Callable, params: dict[str, Any]) -> dict[str, Any]:
    names = inspect.signature(function).parameters
    return {name: value for name, value in params.items() if name in names}


class RowCount:
    """Counts the rows of a frame in whichever action runs it; no scan of its own."""

    def __init__(self, name: str):
        self.observation = Observation(name)

    def __call__(self, data: DataFrame) -> DataFrame:
        return data.observe(self.observation, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]


def run_job(spark: SparkSession, spec: dict[str, Any]) -> dict[str, Any]:
    """Run ``{"job", "source", "sink", "params", "run_date"}`` and report on it.

    The report says whether anything was written and how many rows. ``count_input`` in
    the spec adds the number of rows read: parquet and orc files tell it, by a job that reads
    no column; from other sources all rows must be read for it, which keeps filters from
    being pushed into the scan, so it is opt-in. ``key_index`` in the spec names a folder in
    which the parameter keys of the source's files are kept (see ``indexed_param_keys``): a
    run then looks for keys in files only that no run has seen. Events of large Parquet row
    groups are spread over tasks (see ``spread_large_tasks``) unless ``num_partitions`` is
    given. An empty result is not written. Everything in the spec is checked before Spark
    does any work.
    """
    spec = dict(spec)
    job = spec.get("job")
    if job not in JOBS:
        raise ValueError(f"unknown job {job!r}: use one of {sorted(JOBS)}")
    transform, has_rows = JOBS[job]
    run_date = str(spec["run_date"]) if spec.get("run_date") else None
    read = _backend(SOURCES, spec, "source", run_date)
    write = _backend(SINKS, spec, "sink", run_date)
    params = dict(spec.get("params") or {})
    unknown = sorted(set(params) - set(_known(transform, params)))
    if unknown:
        raise ValueError(f"unknown parameters of {job}: {unknown}")
    if job == "flatten_events" and not any(params.get(name) for name in SELECTORS):
        raise ValueError(f"flatten_events needs one of {list(SELECTORS)}")

    data = read(spark)
    report: dict[str, Any] = {"job": job, "written": False, "rows_written": 0}
    found = None
    if job == "flatten_events" and params.get("param_keys") is None:
        chosen = _known(keep_events, params)
        if spec.get("key_index"):
            found = indexed_param_keys(data, spec["key_index"], params.get("max_keys"), **chosen)
        else:
            found = discover_param_keys(keep_events(data, **chosen), params.get("max_keys"))
        params["param_keys"] = found
    # An event with a key is a row, but for events that need items: no look of its own then.
    settled = found and params.get("event_type") != ECOMMERCE
    if found == [] or not (settled or has_rows(data, **_known(has_rows, params))):
        return report
    rows_read = None
    if spec.get("count_input"):
        if getattr(read, "counted_by_files", False):
            report["rows_read"] = data.count()
        else:
            rows_read = RowCount("rows_read")
            data = rows_read(data)
    if job == "flatten_events" and not params.get("num_partitions") and getattr(read, "rows_numbered", False):
        data = spread_large_tasks(data, keep_events(data, **_known(keep_events, params)))
    # The sink counts where nothing but the write comes after: it may look at rows twice.
    rows_written = RowCount("rows_written")
    write(transform(data, **params), rows_written)
    written = rows_written.rows
    report.update(written=written > 0, rows_written=written)
    if rows_read:
        report["rows_read"] = rows_read.rows
    return report
