"""New folders for the queries that write and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A path nobody used yet, in the folder the cluster shares between executors."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventflat-")
    return f"{base.rstrip('/')}/eventflat-{uuid.uuid4().hex}"


def new_table() -> str:
    return f"eventflat_{uuid.uuid4().hex}"
