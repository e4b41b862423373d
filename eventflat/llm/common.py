"""Helpers shared by the operators: shared folders, text slices, components, hashes."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: runs of anything but ASCII white space (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"

#: Functions whose results a worker keeps.
KEPT: list[Callable] = []

#: Bytes of text that a Python task holds in expanded form at a time.
SLICE_BYTES = 4_000_000


def prepare(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="eventflat-llm-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def ship(data: DataFrame) -> DataFrame:
    """The same frame, once the executors' Python has this package, wherever it lies here."""
    context = data.sparkSession.sparkContext
    name = f"eventflat-{context.applicationId}.zip"
    if not any(str(path).endswith(name) for path in context._python_includes):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="eventflat-code-"), name)
        with zipfile.ZipFile(archive, "w") as packed:
            for folder, _, files in os.walk(top):
                for file in files:
                    if file.endswith(".py"):
                        path = os.path.join(folder, file)
                        packed.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(archive)
    return data


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used."""
    return f"{prepare(spark)}/{name}-{uuid.uuid4().hex}"


def cut(data: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder: lineage ends, lost executors do no harm."""
    prepare(data.sparkSession)
    return data.checkpoint()


def small(data: DataFrame, rows: int) -> DataFrame:
    """The frame marked for broadcast if it has no more than that many (short) rows."""
    return F.broadcast(data) if data.count() <= rows else data


def without(data: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, by the session's rule for case."""
    exact = data.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    taken = set(names) if exact else {name.lower() for name in names}
    kept = [c for c in data.columns if (c if exact else c.lower()) not in taken]
    if len(kept) == len(data.columns):
        return data
    return data.select(*["`" + name.replace("`", "``") + "`" for name in kept])


def stored(data: DataFrame, name: str) -> DataFrame:
    """The same rows from Parquet in the shared folder, computed once."""
    folder = new_folder(data.sparkSession, name)
    data.write.parquet(folder)
    return data.sparkSession.read.parquet(folder)


def storage(path: str):
    """File system and path in it, for files that are no Spark source (pyarrow's file systems)."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(path)


def kept_by_worker(most: int) -> Callable:
    """``lru_cache`` for what a worker may keep between tasks, see ``drop_others``."""

    def mark(make: Callable) -> Callable:
        KEPT.append(lru_cache(maxsize=most)(make))
        return KEPT[-1]

    return mark


def drop_others(used: tuple[Callable, ...] = ()) -> None:
    """Drop what operators that ran in this worker before have kept, but for ``used``.

    Spark hands a worker from one stage to the next, so what each operator keeps would add up.
    """
    others = [made for made in KEPT if made not in used and made.cache_info().currsize]
    for made in others:
        made.cache_clear()
    if others:
        gc.collect()


def slices(
    batches: Iterator[pa.RecordBatch], column: str, *used: Callable
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about SLICE_BYTES of text; a longer text stands alone.

    ``used`` are the ``kept_by_worker`` functions of this operator: those of others are dropped.
    """
    drop_others(used)
    for batch in batches:
        sizes = text_bytes(batch.column(column))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(batch.column(column).type) else pa.binary()
    return [text or b"" for text in batch.column(column).cast(kind).to_pylist()]


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of all texts in a row as codes, the distinct words, and words per text."""
    words: list[bytes] = []
    counts = np.empty(len(texts), dtype=np.int64)
    for place, text in enumerate(texts):
        found = text.split()  # bytes: ASCII white space only
        counts[place] = len(found)
        words += found
    column = np.empty(len(words), dtype=object)
    column[:] = words
    codes, distinct = pd.factorize(column)
    return codes.astype(np.int64), list(distinct), counts


def mixed(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over unsigned 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Least node reachable over ``links`` for each linked node: columns node, component.

    Contraction: each node takes its least neighbour (or itself) as parent, parents are
    doubled until they are roots, links move to the roots, and links inside one vanish. A
    round leaves the nodes without a smaller neighbour, half of them at most, so rounds and
    doublings are logarithmic. Aggregates are minima, combined before the shuffle: a node
    with very many links is no hot spot.
    """
    edges = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("parent")
        )
        parents = cut(parents)
        rising = True
        while rising:
            upper = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            above = cut(parents.join(upper, "parent"))
            rising = not above.where("top <> parent").isEmpty()
            parents = above.select("node", F.col("top").alias("parent"))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            moved = parents.select(F.col("node").alias("component"), F.col("parent"))
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
            labels = cut(labels)
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = cut(
            edges.join(of_a, "a").join(of_b, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return labels
