"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is the set of its distinct word shingles. A sketch has ``rows * bands``
coordinates and is filled in rounds: in each of the first rounds every shingle is put in a
bin that its hash of that round chooses, in the later rounds into the bin of the round's
number, and a bin keeps the least (round, hash). Rounds end when every bin is full, so no
coordinate stays empty however small the set, and agreement of sketches concentrates like
that of a full MinHash at the cost of a few passes over the shingles. Coordinates in bands
of ``rows`` give bucket keys: two sets of similarity 0.8 share none of 52 keys of 8 rows
with a chance of 7 in 100,000.

Documents with the same set are one node. In rounds, every node is compared with one node
that shares a bucket with it but no component yet: first with the one that has the most company
in its buckets, then with the one that the round's hash puts first. So a large group soon
hangs together by a few links for each node. Then, in buckets that still hold several
components, members of different components are compared: pairs inside a component cannot
change the result. So large groups of copies cost a line, not a square; members that no link
has reached still meet the others of their buckets, but only links leave that join.
Pairs whose sketches differ in far more lowest bits than chance allows at the wanted
similarity (4.5 standard deviations) are not compared. Every comparison intersects the full
sets (64-bit shingle hashes).

Defined results: a null or empty text, or one without words, has an empty set and is a
component of its own. Rows are the documents: rows that repeat an id with another text are
linked by their texts; ``component_id`` is the least id in the component, null only if all
its ids are null, and ``kept`` tells whether the row has that id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, components, cut, mixed, ship, slices, small, stored, texts_of

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Nodes (24 bytes each) that may be broadcast to pick their texts; more are joined.
FEW_NODES = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Words per shingle, least similarity in percent, rows of a band, bands."""

    words: int = 5
    percent: int = 80
    rows: int = 8
    bands: int = 52
    rounds: int = 8


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words make one shingle."""
    codes, distinct, counts = coded_words([text.lower() for text in texts])  # bytes: A-Z only
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in distinct], dtype=np.uint64)
    words = hashes[codes] if len(codes) else np.empty(0, dtype=np.uint64)
    last = max(len(words) - width + 1, 0)
    windows = np.zeros(last, dtype=np.uint64)
    for place in range(width):
        windows = mixed(windows * STEP + words[place : place + last])
    sets, start = [], 0
    for count in counts:
        if count >= width:
            sets.append(np.unique(windows[start : start + count - width + 1]))
        elif count:
            whole = np.array([count], dtype=np.uint64)
            for place in range(start, start + count):
                whole = mixed(whole * STEP + words[place : place + 1])
            sets.append(whole)
        else:
            sets.append(np.empty(0, dtype=np.uint64))
        start += count
    return sets


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Sketch of each non-empty set: ``size`` coordinates, each (round, hash) in 64 bits."""
    held = np.full(len(sets) * size, EMPTY, dtype=np.uint64)
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    values = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    active = np.flatnonzero(lengths)
    for turn in range(2 * size):
        if not len(active):
            break
        hashed = mixed(values + np.uint64((turn + 1) * int(STEP) % (1 << 64)))
        if turn < size:
            bins = ((hashed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.int64(turn - size)
        content = (np.uint64(turn) << np.uint64(32)) | (hashed & np.uint64(0xFFFFFFFF))
        np.minimum.at(held, owner * size + bins, content)
        open_ = (held.reshape(-1, size)[active] == EMPTY).any(axis=1)
        if not open_.all():
            active = active[open_]
            flag = np.zeros(len(sets), dtype=bool)
            flag[active] = True
            keep = flag[owner]
            values, owner = values[keep], owner[keep]
    return held.reshape(-1, size)


def band_keys(sketched: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Bucket key of each band; the band's number is part of it."""
    parts = sketched.reshape(len(sketched), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketched), bands)).copy()
    for place in range(rows):
        keys = mixed(keys * STEP + parts[:, :, place])
    return keys.view(np.int64)


def lowest_bits(sketched: np.ndarray) -> np.ndarray:
    """The lowest bit of each coordinate, packed into 64-bit numbers."""
    bits = np.packbits((sketched & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
    wide = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : bits.shape[1]] = bits
    return wide.view(np.int64)


def alike(a: str, b: str, settings: Settings):
    """Whether two columns of lowest bits may belong to sets that are similar enough.

    A coordinate's bits differ with chance (1 - similarity) / 2.
    """
    size = settings.rows * settings.bands
    chance = (1 - settings.percent / 100) / 2
    most = size * chance + 4.5 * (size * chance * (1 - chance)) ** 0.5
    parts = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(-(-size // 64))]
    return sum(parts[1:], parts[0]) <= int(most) + 1


def fingerprint(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def sketched(documents: DataFrame, settings: Settings) -> DataFrame:
    """Columns doc_id, text_key, n_shingles, set_key, keys, bits of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(texts_of(batch, "text"), settings.words)
            drawn = sketches(sets, settings.rows * settings.bands)
            keys, bits = band_keys(drawn, settings.rows, settings.bands), lowest_bits(drawn)
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array([fingerprint(s) if f else None for s, f in zip(sets, full)], pa.binary()),
                    "keys": pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                    "bits": pa.array([k if f else None for k, f in zip(bits, full)], pa.list_(pa.int64())),
                }
            )

    rows = ship(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    schema = "doc_id long, text_key long, n_shingles long, set_key binary, keys array<long>, bits array<long>"
    return rows.mapInArrow(sketch, schema)


def full_sets(wanted: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """Columns node, items (the full set) of nodes given as (node, doc_id, text_key).

    Sets are made again from the texts of these nodes, not kept for all documents.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(texts_of(batch, "text"), settings.words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "items"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("d"), F.xxhash64("text").alias("k"), "text"
    )
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key"))
    texts = rows.join(small(wanted, FEW_NODES), same).select("node", "text")
    # Rows that repeat id and text give one set.
    return texts.mapInArrow(make, "node long, items array<long>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    of_a = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    of_b = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    enough = 100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))
    compared = pairs.join(of_a, "a").join(of_b, "b").withColumn("both", both)
    return compared.where(enough).select("a", "b")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """Columns key, node, n_shingles, bits, weight: nodes of all buckets that hold more than one.

    ``weight`` is the number of members of all the node's buckets: most for a text that many
    others are copies of.
    """
    rows = nodes.select("node", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    rows = stored(rows.join(counts.where("members > 1"), "key"), "near-dup-shared")
    weights = rows.groupBy("node").agg(F.sum("members").alias("weight"))
    return rows.select("node", "key").join(weights.join(nodes.select("node", "n_shingles", "bits"), "node"), "node")


def similar_sizes(a: str, b: str, percent: int):
    """Sets can only be similar enough if the smaller has that share of the larger."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def with_components(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their component, of buckets that hold more than one component."""
    if labels is None:
        return members.withColumn("component", F.col("node"))
    rows = members.join(labels, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    ends = rows.groupBy("key").agg(F.min("component").alias("l"), F.max("component").alias("g"))
    return rows.join(ends.where("l < g").select("key"), "key")


def round_pairs(rows: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """At most one pair per node: with the first node, in the round's order, of one bucket.

    The first round puts the node of the greatest weight first, as a text is likelier similar
    to what its copies come from than to another copy. Later rounds order by a hash, another
    in each bucket, so that no single node decides a round.
    """
    order = F.xxhash64(F.lit(turn), "key", "node")
    order = F.struct(-F.col("weight") if turn == 0 else F.lit(0), F.col("node") if turn == 0 else order)
    first = rows.groupBy("key").agg(
        F.min(F.struct(order.alias("order"), "node", "component", "n_shingles", "bits")).alias("hub")
    )
    near = rows.join(first, "key").where("component <> hub.component")
    near = near.where(similar_sizes("n_shingles", "hub.n_shingles", settings.percent))
    near = near.where(alike("bits", "hub.bits", settings))
    pairs = near.groupBy("node").agg(F.min(F.struct("hub.order", "hub.node")).alias("hub"))
    return pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def links_across(rows: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Distinct links (a, b) of nodes that share a bucket but no component.

    In each bucket the members outside one main component meet all others. The full sets come
    with the members and are intersected in the join, so that only links leave it, however
    many pairs of a bucket are nearly similar enough.
    """
    main = rows.groupBy("key").agg(F.mode("component", deterministic=True).alias("main"))
    rows = stored(rows.join(main, "key").join(sets, "node"), "near-dup-members")
    x, y = rows.where("component <> main").alias("x"), rows.alias("y")
    both = F.size(F.array_intersect("x.items", "y.items"))
    fits = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
        & similar_sizes("x.n_shingles", "y.n_shingles", settings.percent)
        & alike("x.bits", "y.bits", settings)
        & ((100 + settings.percent) * both >= settings.percent * (F.col("x.n_shingles") + F.col("y.n_shingles")))
    )
    links = x.join(y, fits).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    )
    return links.distinct()


def node_components(nodes: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame | None:
    """Columns node, component of every node that is linked; None if none is."""
    members = stored(bucket_members(nodes), "near-dup-buckets")
    wanted = members.select("node").distinct()
    wanted = stored(nodes.join(wanted, "node").select("node", "doc_id", "text_key"), "near-dup-wanted")
    sets = stored(full_sets(wanted, documents, settings), "near-dup-sets")
    links, labels, rows = None, None, members.withColumn("component", F.col("node"))
    for turn in range(settings.rounds):
        pairs = cut(round_pairs(rows, turn, settings))
        tried = pairs.count()
        found = cut(verified(pairs, sets, settings.percent))
        new = found.count()
        if new:
            links = found if links is None else links.union(found)
            labels = components(links)
            rows = cut(with_components(members, labels))
        # Where a round links few of its pairs, the rest are pairs to settle one by one.
        if 20 * new <= tried:
            break
    more = cut(links_across(rows, sets, settings))
    if more.isEmpty():
        return labels
    return components(more if links is None else links.union(more))


def near_duplicates(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Columns doc_id, n_shingles, component_id, kept of every row, and text_key, component.

    ``component`` numbers the components of this run, null for empty sets.
    """
    rows = stored(sketched(documents, settings), "near-dup-sketches")
    distinct = rows.where("n_shingles > 0").dropDuplicates(["set_key"])
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "near-dup-nodes")
    labels = node_components(nodes, documents, settings)
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("component")).limit(0)
    least = rows.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    named = (
        nodes.select("set_key", "node").join(least, "set_key").join(labels, "node", "left")
        .select("set_key", "least", F.coalesce("component", "node").alias("component"))
    )
    named = cut(named)
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = named.join(ids, "component").select("set_key", "component_id", "component")
    found = rows.drop("keys", "bits").join(by_set, "set_key", "left")
    least_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.withColumn("component_id", least_id).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_key", "component",
    )


def representatives(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each component, of its least id, with the columns of the documents.

    Every row with an empty set stays, but for rows that repeat both id and text.
    """
    found = stored(near_duplicates(documents, settings).where("kept"), "near-dup-kept")
    first = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("_")
    )
    stay = first.select("_.doc_id", "_.text_key").union(
        found.where("component is null").select("doc_id", "text_key").distinct()
    )
    stay = stay.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
    rows = documents.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_text_key"),
    )
    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_text_key") == F.col("_k"))
    return rows.join(stay, same).dropDuplicates(["_d", "_k"]).select("_row.*")
