"""The prefix trie of conversations: one node per distinct sequence of first turns.

Conversations are sorted as sequences of turns, ties by id, over range partitions. An edge
joins neighbours and weighs as many turns as they share from the start. A union-find takes
the edges of a partition in descending depth: the components it merges at a depth are the
branches of a node there, and the depths between a component's own and its parent's are its
chain of nodes with one child. All other figures of a node are sums over its rows and inner
edges:

- members: edges + 1; leaves: rows whose successor shares less than the row's own turns;
- children: edges of exactly the node's depth whose right row goes on, and the first row if
  it goes on;
- tokens saved below and at the node: over its edges, the tokens of the shared turns, less
  those above the node.

Only nodes on the edge to a neighbouring partition go beyond it. They are emitted as pieces
with the partition in which the node starts, which follows from three numbers for each
partition (turns shared with the one before, least of its own edges, its place), and are
added up by (partition, depth). Nothing else crosses a boundary, so a node with a third of
all rows is a sum of one row per partition. Its list of ids is hashed in order of
partitions, as a stream.

Defined results: null roles and texts are empty; turns of one conversation with equal
numbers come by role, then digest; a null number comes first. Rows without ``conv_id`` belong
to no conversation and are left out. An empty table has no nodes, not even the root. Equal
conversations are members of the same nodes. A conversation is a row of 24 bytes a turn, so
its length is bounded by the memory of a task, as that of a text is. Turns are compared by
128 bits of SHA-256. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, cut, ship, small, stored

#: Bytes of a turn's key.
KEY = 16
#: Nodes of which more are joined by key instead of broadcast.
FEW_NODES = 200_000
#: Turns that a partition of sorted conversations holds on average, at most.
TURNS_PER_TASK = 200_000

EDGE_ROWS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("least", T.LongType()),
        T.StructField("first", T.BinaryType()),
        T.StructField("last", T.BinaryType()),
    ]
)
#: Least depth of no edge at all.
DEEP = 1 << 40
#: Rows of an Arrow batch of nodes.
BATCH = 10_000
#: Nodes and pieces of nodes. ``root_part`` is set for a piece: with the depth it names the
#: node. ``parent_part`` is set where the parent is such a node.
NODES = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("root_part", T.IntegerType()),
        T.StructField("depth", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("parent_part", T.IntegerType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("shared_tokens", T.LongType()),
        T.StructField("tokens_above", T.LongType()),
        T.StructField("ends", T.BinaryType()),
        T.StructField("ends_sha256", T.StringType()),
    ]
)


def sequences(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``turns``, an ordered array of (key, words)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"),
            role.alias("role"),
            F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * KEY)).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ).alias("entry"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("entry")).alias("turns"))
    return grouped.selectExpr("conv_id", "transform(turns, t -> struct(t.key, t.words)) as turns")


def with_planted_heads(sequences: DataFrame) -> DataFrame:
    """The sequences of the digest query: many start with turns of another conversation.

    Conversation c takes the first h turns of conversation c - c % 20 (all if fewer, none if
    absent), then its own but the first h; h is the unsigned crc32 of the decimal c, modulo 4.
    """
    heads = sequences.where("conv_id % 20 = 0").selectExpr(
        "conv_id as base", "slice(turns, 1, 3) as head"
    )
    drawn = sequences.selectExpr(
        "*", "conv_id - conv_id % 20 as base", "int(crc32(binary(string(conv_id))) % 4) as h"
    )
    return drawn.join(heads, "base", "left").selectExpr(
        "conv_id",
        "concat(coalesce(slice(head, 1, h), slice(turns, 1, 0)), "
        "slice(turns, h + 1, size(turns))) as turns",
    )


class Sorted(NamedTuple):
    """Rows of one partition, in order of keys, then ids."""

    part: int
    ids: list[int]
    keys: list[bytes]
    tokens: list[list[int]]  # words of the first 0, 1, … turns


class Borders(NamedTuple):
    """Of each partition that has rows, in order: its number, turns its first row shares with
    the row before (-1 for the first partition), and the least of its own edges."""

    parts: list[int]
    before: list[int]
    least: list[int]


def shared(one: bytes, other: bytes) -> int:
    """Turns that two keys have in common from the start."""
    most = min(len(one), len(other))
    if one[:most] == other[:most]:
        return most // KEY
    low, high = 0, most // KEY  # the first ``low`` turns agree, the first ``high`` do not
    while high - low > 1:
        middle = (low + high) // 2
        if one[low * KEY : middle * KEY] == other[low * KEY : middle * KEY]:
            low = middle
        else:
            high = middle
    return low


def rows_of(batches: Iterator[pa.RecordBatch]) -> Sorted | None:
    part, ids, keys, tokens = -1, [], [], []
    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
            ids += batch.column("conv_id").to_pylist()
            keys += batch.column("key").to_pylist()
            tokens += [list(accumulate(w, initial=0)) for w in batch.column("words").to_pylist()]
    return Sorted(part, ids, keys, tokens) if ids else None


def starts_of(borders: Borders, place: int) -> list[int]:
    """The partition in which the node of depth 0, 1, … begins that the first row shares
    with the row before it."""
    found = []
    at = place - 1
    for depth in range(borders.before[place], -1, -1):
        while borders.least[at] >= depth and borders.before[at] >= depth:
            at -= 1
        found.append(borders.parts[at])
    return found[::-1]


def nodes_of(rows: Sorted, borders: Borders) -> Iterator[tuple]:
    """All nodes of a partition's rows, and its pieces of those that go beyond it."""
    place = borders.parts.index(rows.part)
    count = len(rows.ids)
    size = [len(key) // KEY for key in rows.keys]
    before = borders.before[place]
    after = borders.before[place + 1] if place + 1 < len(borders.parts) else -1
    started = starts_of(borders, place) if before >= 0 else []
    lcp = [before, *map(shared, rows.keys[:-1], rows.keys[1:]), after]
    sums = list(accumulate(rows.tokens[row][lcp[row]] if row else 0 for row in range(count)))
    leaves = list(accumulate((lcp[row + 1] < size[row] for row in range(count)), initial=0))

    top = list(range(count))  # union-find: a component is a stretch, named by its first row
    last = list(range(count))
    least = list(rows.ids)
    deep = list(size)  # depth of the component's node
    branches = [0] * count  # inner edges of just that depth whose right row goes on

    def find(row: int) -> int:
        while top[row] != row:
            top[row] = row = top[top[row]]
        return row

    def start_part(first: int, stop: int, depth: int) -> int | None:
        """The partition in which a node starts that goes beyond this one."""
        if first == 0 and depth <= before:
            return started[depth]
        return rows.part if stop == count - 1 and depth <= after else None

    def chain(first: int, above: int, parent: tuple[int, int, int] | None) -> Iterator[tuple]:
        """A component's nodes deeper than ``above``, where its parent (first and last row,
        least member) has its node."""
        stop, tokens = last[first], rows.tokens[first]
        inner, below = sums[stop] - sums[first], leaves[stop + 1] - leaves[first]
        for level in range(deep[first], above, -1):
            joined = first == 0 and level <= before
            goes_on = size[first] > level and (not joined or level == before)
            bottom = level == deep[first]
            ends = []
            if bottom:
                row = first
                while row <= stop and size[row] == level:
                    ends.append(str(rows.ids[row]))
                    row += 1
            listed = ",".join(ends).encode()
            own_part = start_part(first, stop, level)
            up_first, up_stop, name = (first, stop, least[first])
            if level - 1 == above and parent:
                up_first, up_stop, name = parent
            up_part = start_part(up_first, up_stop, level - 1) if level else None
            yield (
                rows.part,
                own_part,
                level,
                least[first],
                name if level and up_part is None else None,
                up_part,
                stop - first + 1,
                (branches[first] if bottom else 0) + goes_on,
                below,
                inner + (tokens[before] if joined else 0),
                tokens[level - 1] if level else 0,
                listed if own_part is not None and listed else None,
                hashlib.sha256(listed).hexdigest() if own_part is None else None,
            )

    edges = sorted(range(1, count), key=lcp.__getitem__, reverse=True)
    at = 0
    while at < len(edges):
        depth, begin = lcp[edges[at]], at
        while at < len(edges) and lcp[edges[at]] == depth:
            at += 1
        merged: dict[int, list[int]] = {}
        for row in edges[begin:at]:  # ascending, as the sort is stable
            left = find(row - 1)
            merged.setdefault(left, [left]).append(row)
            top[row] = left
        for left, members in merged.items():
            member, stop = min(least[child] for child in members), last[members[-1]]
            for child in members:
                yield from chain(child, depth, (left, stop, member))
            branches[left] = sum(size[child] > depth for child in members[1:])
            least[left], last[left], deep[left] = member, stop, depth
    yield from chain(0, -1, None)


def sorted_rows(sequences: DataFrame) -> DataFrame:
    """Conversations sorted by key, then id, over range partitions, stored: part, conv_id,
    key, words."""
    sequences = cut(sequences)
    total = sequences.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    width = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sequences.selectExpr(
        "conv_id",
        "unhex(array_join(transform(turns, t -> hex(t.key)), '')) as key",
        "turns.words as words",
    )
    parts = max(width, -(-total // TURNS_PER_TASK))
    rows = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    return cut(rows.select(F.spark_partition_id().alias("part"), "*"))


def borders_of(rows: DataFrame) -> Borders:
    """Three numbers for each partition, on the driver; see the class."""

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rows_of(batches)
        if own:
            least = min(map(shared, own.keys[:-1], own.keys[1:]), default=DEEP)
            values = [(own.part, pa.int32()), (least, pa.int64())]
            values += [(own.keys[0], pa.binary()), (own.keys[-1], pa.binary())]
            columns = [pa.array([value], kind) for value, kind in values]
            yield pa.RecordBatch.from_arrays(columns, EDGE_ROWS.names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch["previous"].to_pylist(), batch["first"].to_pylist(), strict=True)
            met = [-1 if one is None else shared(one, other) for one, other in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch["part"], pa.array(met, pa.int64()), batch["least"]], ["part", "met", "least"]
            )

    outlines = ship(rows).mapInArrow(outline, EDGE_ROWS)
    # One row for each partition.
    previous = F.lag("last").over(Window.orderBy("part")).alias("previous")
    pairs = outlines.select("part", "least", "first", previous)
    found = sorted(pairs.mapInArrow(compare, "part int, met long, least long").collect())
    return Borders(*[[row[i] for row in found] for i in range(3)])


def ends_of(pieces: DataFrame) -> DataFrame:
    """Digest of the ids of a node's pieces, hashed in order of their partitions."""
    key = ["root_part", "depth"]
    schema = "root_part int, depth long, ends_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            rows = zip(*[batch[name] for name in (*key, "ends")], strict=True)
            for root_part, depth, ends in rows:
                own = (root_part.as_py(), depth.as_py())
                if own != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.as_buffer())
        if node:
            done.append((*node, state.hexdigest()))
        if done:
            names = ["root_part", "depth", "ends_sha256"]
            kinds = [pa.int32(), pa.int64(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = pieces.where("ends is not null").select(*key, "part", "ends")
    return rows.repartition(*key).sortWithinPartitions(*key, "part").mapInArrow(digest, schema)


def trie(sequences: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations (``conv_id``, ``turns``)."""
    rows = sorted_rows(sequences)
    borders = borders_of(rows)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rows_of(batches)
        if not own:
            return
        types = [pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 5]
        types += [pa.binary(), pa.string()]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(zip(*held, strict=True), types, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], NODES.names)

        for node in nodes_of(own, borders):
            held.append(node)
            if len(held) >= BATCH:
                yield batch()
                held = []
        if held:
            yield batch()

    found = stored(ship(rows).mapInArrow(emit, NODES), "trie")
    pieces = found.where("root_part is not null")
    key = ["root_part", "depth"]
    whole = pieces.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("parent_part").alias("parent_part"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared_tokens")],
        F.max("tokens_above").alias("tokens_above"),
    )
    whole = cut(whole.join(ends_of(pieces), key, "left"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = whole.withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    names = whole.selectExpr("root_part as parent_part", "depth + 1 as depth", "conv_id as name")
    whole = whole.join(small(names, FEW_NODES), ["parent_part", "depth"], "left").withColumn(
        "parent_conv_id", F.col("name")
    )
    # A node's parent that goes beyond the partition is named there by one of its pieces: the
    # partition in the key parts the children of a node that has very many.
    local = pieces.selectExpr("part", "root_part as parent_part", "depth + 1 as depth")
    local = local.join(small(names, FEW_NODES), ["parent_part", "depth"])
    closed = found.where("root_part is null")
    closed = closed.join(small(local, FEW_NODES), ["part", "parent_part", "depth"], "left")
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "name"))
    columns = [
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "shared_tokens - (n_convs - 1) * tokens_above as saved_tokens",
        "ends_sha256",
    ]
    return closed.selectExpr(*columns).unionByName(whole.selectExpr(*columns))
