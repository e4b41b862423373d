"""Flatten nested event exports and aggregate them to sessions, on Spark."""

from .plans import flatten_events, flatten_sessions, run_job
from .sources import (
    file_sink,
    file_source,
    parquet_sink,
    parquet_source,
    table_sink,
    table_source,
)

__all__ = [
    "file_sink",
    "file_source",
    "flatten_events",
    "flatten_sessions",
    "parquet_sink",
    "parquet_source",
    "run_job",
    "table_sink",
    "table_source",
]
