"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors become unit vectors in double precision, where a cosine bounds a distance. The top
of a cover tree is fitted per label on a bounded sample: levels of centers with halving
radii. Every vector descends to its nearest leaf center; a cell's covering radius is the
greatest distance found in it. Large cells are cut into blocks of ``BLOCK`` vectors. Two
cells meet only if their centers are nearer than both radii and the link distance, and a
vector goes to a meeting only if it can reach the other cell. A meeting of two blocks is one
group of bounded size: there a cover tree is built over each block, pairs of nodes are
pruned by their covering radii, and the pairs left are compared by their cosine.

A meeting returns, for each vector with a link, the number of copies it is linked with and
one link of a spanning forest: links are all counted, never all written.

Defined results: rows with a null label, and vectors that are null, empty, zero or hold
null or non-finite components, are components of their own with no link; so are vectors of
another length than the rest of a meeting. Equal vectors of a label are one node with
copies. Null ids count as copies; a component's id is its least id. Extra columns are
ignored. The empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, cut, ship, stored

LEAST = 0.98
#: Vectors of one block, and sampled rows from which the tops of the trees are fitted.
BLOCK, SAMPLE = 2_048, 8_192
#: Slack for rounding in bounds; the comparison itself has none.
SLACK = 1e-9


def reach(least: float) -> float:
    """Greatest distance of two unit vectors with that cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of x to all rows of y, for unit vectors."""
    return np.sqrt(np.clip(2 - 2 * (x @ y.T), 0, None))


class CoverTree:
    """Nested levels of centers: a node's children lie within its radius, and radii halve.

    ``levels[i]`` is (centers, parents, radii): rows of the data that are centers, places of
    their parents in the level before, and covering radii (greatest distance to a
    descendant). The last level holds every row as a center of its own or of equal rows.
    """

    def __init__(self, data: np.ndarray, smallest: float = 0.05):
        self.data = data
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        centers, owner = np.array([0]), np.zeros(len(data), dtype=np.int64)
        self.levels.append((centers, np.array([-1]), self.radii(centers, owner)))
        radius = 1.0
        while radius >= smallest and len(centers) < len(data):
            centers, parents, owner = self.split(owner, len(centers), radius)
            self.levels.append((centers, parents, self.radii(centers, owner)))
            radius /= 2
        self.owner = owner

    def radii(self, centers: np.ndarray, owner: np.ndarray) -> np.ndarray:
        apart = np.linalg.norm(self.data - self.data[centers[owner]], axis=1)
        found = np.zeros(len(centers))
        np.maximum.at(found, owner, apart)
        return found

    def split(self, owner: np.ndarray, nodes: int, radius: float):
        """Centers within each node so that no row is farther than ``radius`` from its own."""
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(nodes + 1))
        centers, parents, new = [], [], np.empty_like(owner)
        for node in range(nodes):
            left = order[ends[node] : ends[node + 1]]
            while len(left):
                first = left[0]
                near = np.linalg.norm(self.data[left] - self.data[first], axis=1) <= radius
                new[left[near]] = len(centers)
                centers.append(first)
                parents.append(node)
                left = left[~near]
                if len(left) and len(centers) > len(self.data) // 2:
                    # Rows too far apart for balls: each is its own center from here on.
                    new[left] = np.arange(len(centers), len(centers) + len(left))
                    centers.extend(left)
                    parents.extend([node] * len(left))
                    break
        return np.array(centers), np.array(parents), new


def near_rows(x: CoverTree, y: CoverTree, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Dual traversal: pairs of rows whose leaf balls come within ``limit``, as two masks.

    Level by level, the children of node pairs that are left are held against their
    covering radii; nodes without a partner drop out with all their descendants.
    """
    live = np.ones((1, 1), dtype=bool)
    a = b = np.array([0])
    for level in range(max(len(x.levels), len(y.levels))):
        if level:
            a, up_a = below(x, level, a)
            b, up_b = below(y, level, b)
            live = live[np.ix_(up_a, up_b)]
        ca, _, ra = x.levels[min(level, len(x.levels) - 1)]
        cb, _, rb = y.levels[min(level, len(y.levels) - 1)]
        apart = distances(x.data[ca[a]], y.data[cb[b]])
        live &= apart <= ra[a][:, None] + rb[b][None, :] + limit + SLACK
        some_a, some_b = live.any(axis=1), live.any(axis=0)
        a, b, live = a[some_a], b[some_b], live[np.ix_(some_a, some_b)]
        if not live.size:
            break
    place_a = np.full(len(x.levels[-1][0]), -1)
    place_b = np.full(len(y.levels[-1][0]), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    return place_a[x.owner], place_b[y.owner], live


def below(tree: CoverTree, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes at a level, and for each the place of its parent in ``nodes``."""
    if level >= len(tree.levels):
        return nodes, np.arange(len(nodes))
    place = np.full(len(tree.levels[level - 1][0]), -1)
    place[nodes] = np.arange(len(nodes))
    up = place[tree.levels[level][1]]
    return np.flatnonzero(up >= 0), up[up >= 0]


def links_between(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact pairs (row of x, row of y) with cosine ``least`` or more; all rows unit vectors."""
    limit = reach(least)
    place_a, place_b, live = near_rows(CoverTree(x), CoverTree(y), limit)
    rows_a, rows_b = np.flatnonzero(place_a >= 0), np.flatnonzero(place_b >= 0)
    if not len(rows_a) or not len(rows_b) or not live.size:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    cosines = x[rows_a] @ y[rows_b].T
    found = (cosines >= least) & live[np.ix_(place_a[rows_a], place_b[rows_b])]
    i, j = np.nonzero(found)
    return rows_a[i], rows_b[j]


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least row reachable from each row over the pairs."""
    label = np.arange(size)
    while len(i):
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            break
        label = least
    return label


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles, scaled to length 1."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def met(table: pa.Table, least: float) -> pa.Table:
    """One meeting: two blocks, or a block with itself (side 0 only)."""
    side = table.column("side").to_numpy()
    node = table.column("node").to_numpy()
    copies = table.column("copies").to_numpy()
    rows = matrix(table.column("vector"))
    own, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if table.column("alone")[0].as_py():
        i, j = links_between(rows, rows, least)
        i, j = i[i < j], j[i < j]
    elif len(own) and len(other):
        i, j = links_between(rows[own], rows[other], least)
        i, j = own[i], other[j]
    else:
        i = j = np.empty(0, dtype=np.int64)
    links = np.bincount(i, weights=copies[j], minlength=len(node))
    links += np.bincount(j, weights=copies[i], minlength=len(node))
    root = forest(len(node), i, j)
    at = np.flatnonzero(links)
    return pa.table({"node": node[at], "links": links[at].astype(np.int64), "root": node[root[at]]})


def valid(embedding: str = "embedding"):
    """A label, and finite components that are not all zero."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(embedding, lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))


def fitted_tops(nodes: DataFrame, block: int, sample: int) -> dict[tuple, np.ndarray]:
    """Leaf centers by (label, length), for groups of more than a block, from a bounded sample."""
    total = nodes.count()
    share = min(1.0, sample / max(total, 1))
    # A share of 2 ** 53 draws: never empty for being small.
    pick = F.shiftrightunsigned(F.xxhash64("node"), 11) < F.lit(max(1, int(share * (1 << 53))))
    rows = nodes.where(pick).select("label", "length", "vector").toArrow()
    found = {}
    if not rows.num_rows:
        return found
    frame = pd.DataFrame({"label": rows.column("label").to_pylist(), "length": rows.column("length").to_pylist()})
    for key, places in frame.groupby(["label", "length"]).indices.items():
        cells = int(np.ceil(len(places) / share / block))
        if cells < 2:
            continue
        data = matrix(rows.column("vector").take(pa.array(places)))
        levels = [level for level in CoverTree(data).levels if len(level[0]) <= 4 * cells]
        found[key] = data[levels[-1][0]]
    return found


def partners(tops: dict, radii: dict, limit: float) -> dict:
    """For each cell of a fitted group: cells, itself included, whose ball can hold a link."""
    found = {}
    for key, centers in tops.items():
        sizes = np.array([radii.get((*key, cell), (0.0, 0))[0] for cell in range(len(centers))])
        full = np.array([(*key, cell) in radii for cell in range(len(centers))])
        near = distances(centers, centers) <= sizes[:, None] + sizes[None, :] + limit + SLACK
        np.fill_diagonal(near, True)
        for cell in np.flatnonzero(full):
            found[(*key, int(cell))] = [int(c) for c in np.flatnonzero(near[cell] & full)]
    return found


def in_cells(nodes: DataFrame, tops: dict) -> DataFrame:
    """Nodes with their nearest leaf center and the distance to it."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pd.DataFrame({name: batch.column(name).to_pylist() for name in ("label", "length")})
            cell, apart = np.zeros(len(keys), dtype=np.int32), np.zeros(len(keys))
            for key, places in keys.groupby(["label", "length"]).indices.items():
                if key in tops:
                    rows = matrix(batch.column("vector").take(pa.array(places)))
                    away = distances(rows, tops[key])
                    cell[places] = away.argmin(axis=1)
                    apart[places] = away.min(axis=1)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cell), pa.array(apart)],
                names=[*batch.schema.names, "cell", "apart"],
            )

    schema = T.StructType([*nodes.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("apart", T.DoubleType())])
    return ship(nodes).mapInArrow(assign, schema)


def meetings(placed: DataFrame, cells: DataFrame, tops: dict, least: float, block: int) -> DataFrame:
    """Rows of each meeting of two blocks: columns meeting, alone, side, node, copies, vector."""
    limit = reach(least)
    # Cells of fitted groups are bounded by the sample; other groups have one cell.
    fitted = cells.where("parts > 0").where(F.col("fitted"))
    radii = {
        (row["label"], row["length"], row["cell"]): (row["radius"], row["parts"])
        for row in fitted.collect()
    }
    near = partners(tops, radii, limit)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, length = batch.column("label").to_pylist(), batch.column("length").to_pylist()
            cell, part = batch.column("cell").to_pylist(), batch.column("part").to_pylist()
            parts = batch.column("parts").to_pylist()
            units: dict = {}
            out: list[list] = [[], [], [], []]
            for at in range(batch.num_rows):
                key, own = (label[at], length[at]), (cell[at], part[at])
                for other in near.get((*key, cell[at]), [cell[at]]):
                    blocks = parts[at] if other == cell[at] else radii[(*key, other)][1]
                    if other != cell[at]:
                        if at not in units:
                            units[at] = matrix(batch.column("vector").slice(at, 1))
                        away = distances(units[at], tops[key][other : other + 1])[0, 0]
                        if away > radii[(*key, other)][0] + limit + SLACK:
                            continue
                    for number in range(blocks):
                        pair = sorted([own, (other, number)])
                        out[0].append(f"{key[0]}/{key[1]}/{pair[0][0]}.{pair[0][1]}/{pair[1][0]}.{pair[1][1]}")
                        out[1].append(pair[0] == pair[1])
                        out[2].append(int(own != pair[0]))
                        out[3].append(at)
            for start in range(0, len(out[0]), 20_000):
                stop = start + 20_000
                places = pa.array(out[3][start:stop], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out[0][start:stop], pa.string()),
                        pa.array(out[1][start:stop], pa.bool_()),
                        pa.array(out[2][start:stop], pa.int32()),
                        *[batch.column(name).take(places) for name in ("node", "copies", "vector")],
                    ],
                    names=["meeting", "alone", "side", "node", "copies", "vector"],
                )

    rows = placed.join(cells.drop("radius", "fitted"), ["label", "length", "cell"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    schema = "meeting string, alone boolean, side int, node long, copies long, vector array<double>"
    return rows.select("label", "length", "cell", "part", "parts", "node", "copies", "vector").mapInArrow(deal, schema)


def node_links(nodes: DataFrame, least: float, block: int, sample: int) -> DataFrame:
    """Columns node, links, root for every meeting in which a node has a link."""
    tops = fitted_tops(nodes, block, sample)
    placed = stored(in_cells(nodes, tops), "cover-tree-cells")
    known = {(int(a), int(b)) for a, b in tops}
    own = F.concat_ws("/", "label", "length")
    is_fitted = own.isin([f"{a}/{b}" for a, b in known]) if known else F.lit(False)
    cells = cut(
        placed.groupBy("label", "length", "cell")
        .agg(F.max("apart").alias("radius"), F.count(F.lit(1)).alias("n"))
        .select(
            "label", "length", "cell", "radius",
            F.ceil(F.col("n") / block).cast("int").alias("parts"), is_fitted.alias("fitted"),
        )
    )
    dealt = meetings(placed, cells, tops, least, block)
    return dealt.groupBy("meeting").applyInArrow(
        lambda table: met(table, least), "node long, links long, root long"
    )


def near_duplicates(embeddings: DataFrame, least: float = LEAST, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept of every vector."""
    vector = F.transform("embedding", lambda v: v.cast("double") + 0.0)
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.when(valid(), vector).alias("vector"),
    )
    rows = rows.select(
        "vec_id", "label", "vector",
        F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "label", "vector")).alias("h1"),
        F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(2), "label", "vector")).alias("h2"),
    )
    # Equal vectors of a label are told by 128 bits of hash.
    groups = rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
    )
    nodes = groups.withColumn("node", F.monotonically_increasing_id())
    nodes = stored(nodes.withColumn("length", F.size("vector").cast("long")), "cover-tree-nodes")
    found = stored(
        node_links(nodes.select("node", "label", "length", "copies", "vector"), least, block, sample),
        "cover-tree-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select("node", "root"), "node", "root")
    named = nodes.select("h1", "h2", "node", "copies", "least").join(links, "node", "left").join(labels, "node", "left")
    named = cut(named.withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_vector = named.join(ids, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    result = rows.select("vec_id", "h1", "h2").join(by_vector, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
