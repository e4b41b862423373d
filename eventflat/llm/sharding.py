"""Sharding by a hierarchical weighted hash tree, in built-in functions only.

Regions hold racks and racks hold shards. A row descends from the root: at each node every
child draws -ln(u) / weight, u being a hash of the row's key and the child's path, and the
least draw wins; a weight is the number of shards below. When a weight changes, only rows
that the changed child wins or loses move. A further shard joins a given tree as a region of
its own, whatever the tree is, so rows move into it and nowhere else. Such shards stay regions
until somebody folds them into one, which is a new tree and moves rows between its shards.

Defined results: a null text has one unit of size and the checksum of no bytes; a null key
is a key like any other; rows that repeat a key share its shard and get slots of their own.
An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A tree as nested lists: regions of racks of shard numbers.
Tree = list[list[list[int]]]

#: Parts of a shard whose rows are numbered side by side.
PARTS = 512


def tree(shards: int, racks: int = 2, per_rack: int = 2) -> Tree:
    """Shards 0.. in racks of ``per_rack``, ``racks`` to a region; each of a rest is a region."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    region = racks * per_rack
    whole = shards - shards % region
    regions = [
        [list(range(at, at + per_rack)) for at in range(start, start + region, per_rack)]
        for start in range(0, whole, region)
    ]
    return regions + [[[number]] for number in range(whole, shards)]


def grown(held: Tree) -> Tree:
    """The tree with one more shard, as a region of its own."""
    return [*held, [[sum(len(rack) for region in held for rack in region)]]]


def nested(values) -> Column:
    """Nested lists as nested arrays."""
    if isinstance(values, list):
        return F.array(*[nested(value) for value in values])
    return F.lit(values)


def winner(key: Column, path: Column, weights: Column) -> Column:
    """Place of the child with the least draw."""

    def draw(weight: Column, place: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(path, place, key), 11)
        value = -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / weight
        return F.struct(value.alias("draw"), place.alias("place"))

    return F.array_min(F.transform(weights, draw))["place"]


def with_shard(rows: DataFrame, key: Column, held: Tree, name: str) -> DataFrame:
    """The rows with column ``name``: the shard each key descends to."""
    by_region = nested([float(sum(map(len, region))) for region in held])
    by_rack = nested([[float(len(rack)) for rack in region] for region in held])
    by_shard = nested([[[1.0] * len(rack) for rack in region] for region in held])
    r, k, s = f"_{name}_region", f"_{name}_rack", f"_{name}_place"
    rows = rows.withColumn(r, winner(key, F.lit("root"), by_region))
    path = F.concat_ws("/", F.lit("root"), F.col(r))
    rows = rows.withColumn(k, winner(key, path, F.get(by_rack, F.col(r))))
    path = F.concat_ws("/", path, F.col(k))
    rows = rows.withColumn(s, winner(key, path, F.get(F.get(by_shard, F.col(r)), F.col(k))))
    found = F.get(F.get(F.get(nested(held), F.col(r)), F.col(k)), F.col(s))
    return rows.withColumn(name, found).drop(r, k, s)


def sharded(documents: DataFrame, shards: int = 16) -> DataFrame:
    """Columns doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    A slot is a row's number in its shard, gapless from 0. Rows are numbered within the parts
    of a shard, after the rows of earlier parts: no task orders a whole shard.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    part = F.pmod(F.xxhash64(F.lit("part"), key), F.lit(PARTS)).cast("int")
    held = tree(shards)
    placed = with_shard(documents.select("doc_id", "text"), key, held, "shard")
    placed = placed.withColumn("_part", part)

    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards x PARTS rows, whatever the table holds: the broadcast is bounded.
    before = counts.select(
        F.col("shard").alias("_shard"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
    )
    rows = placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        "shard",
        "_part",
    )
    own = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_number", F.row_number().over(own) - 1)
    same = (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_of"))
    numbered = numbered.join(F.broadcast(before), same)
    return with_shard(numbered, key, grown(held), "grown_shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_before") + F.col("_number")).cast("long").alias("slot"),
        "grown_shard",
    )
