"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder with the test tables, ``BENCH_CPUS`` the local cores.
The nested events are derived and stored once, outside the timing; each query then reads
them from parquet and is drained by a sink that keeps nothing. All queries take turns in
four rounds, and the least time of each counts. ``plain`` holds the same two jobs as
explode-and-pivot and as one window.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from plain import explode_and_pivot, windowed_sessions  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from eventflat import flatten_events, flatten_sessions, run_job  # noqa: E402
from eventflat.fixture import load_nested_events  # noqa: E402
from eventflat.operators import discover_param_keys, keep_events  # noqa: E402

ROUNDS = 4
NAMES = ["click", "error", "purchase", "signup", "view"]


def session(cpus: str) -> SparkSession:
    built = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventflat-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    return built


def drain(data) -> None:
    data.write.format("noop").mode("overwrite").save()


def least(queries: dict) -> dict[str, float]:
    """Least time of each query over rounds in which all of them take their turn."""
    times = {name: [] for name in queries}
    for _ in range(ROUNDS):
        for name, action in queries.items():
            start = time.perf_counter()
            action()
            times[name].append(time.perf_counter() - start)
    return {name: round(min(found), 3) for name, found in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    folder = tempfile.mkdtemp(prefix="eventflat-bench-")
    derived = load_nested_events(spark, sf_dir, collected=True)
    derived.repartition(int(cpus)).write.parquet(f"{folder}/in")
    nested = spark.read.parquet(f"{folder}/in")

    def job(name: str, params: dict) -> None:
        source = {"type": "parquet", "path": f"{folder}/in"}
        sink = {"type": "parquet", "path": f"{folder}/{name}"}
        run_job(spark, {"job": name, "params": params, "source": source, "sink": sink})

    queries = {
        "param_keys": lambda: discover_param_keys(nested),
        "flatten_events_purchase": lambda: drain(flatten_events(nested, "purchase")),
        "flatten_events_all": lambda: drain(flatten_events(nested, event_list=NAMES)),
        "flatten_events_all_unique": lambda: drain(
            flatten_events(nested, event_list=NAMES, assume_unique=True)
        ),
        "flatten_events_ecommerce": lambda: drain(
            flatten_events(nested, "purchase", "ecommerce")
        ),
        "flatten_sessions": lambda: drain(flatten_sessions(nested)),
        "job_events": lambda: job("flatten_events", {"event_list": NAMES}),
        "job_sessions": lambda: job("flatten_sessions", {}),
    }

    def pivot(name: str | None) -> None:
        condition = f"event_name = '{name}'" if name else "event_name IS NOT NULL"
        kept = keep_events(nested, name, None if name else NAMES)
        drain(explode_and_pivot(nested, condition, discover_param_keys(kept)))

    plain = {
        "flatten_events_purchase": lambda: pivot("purchase"),
        "flatten_events_all": lambda: pivot(None),
        "flatten_sessions": lambda: drain(windowed_sessions(nested)),
    }
    found = least({**queries, **{f"plain {name}": action for name, action in plain.items()}})
    times = {name: found[name] for name in queries}
    plain_times = {name: found[f"plain {name}"] for name in plain}
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the least times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "plain": plain_times,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
