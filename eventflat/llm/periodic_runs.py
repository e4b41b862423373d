"""Periodic runs of words, found with suffix trees of a text and its reversal.

A run is a stretch of consecutive words with smallest period q and a length of at least 24
and 3 q, that no neighbouring word extends keeping that period. Each run holds, in one of
two orders of the words, a Lyndon word of length q that is the longest one at its start: it
ends at the next smaller suffix. So each position gives a candidate in either order, which
is extended both ways by the longest common extension of its two ends: the string depth of
the lowest common ancestor of two leaves, a range minimum over the Euler tour of a suffix
tree (Ukkonen). The tree of the reversed words answers for the extension to the left.

Trees are built for the stretches that can hold a run only. Any 8 consecutive words of a
run occur again in it, one period on or back, as its length is at least 2 q + 8. Words in no
repeated window of 8 thus lie in no run, and a run lies between two of them. Equal windows
are found by hash: a collision leaves more words in, never fewer. Several stretches share
a pair of trees, parted by symbols that occur once.

Defined results: a null or empty text, or one of white space only, has no runs and an empty
collapsed text. Repeated rows each get their own equal result. Null ids do not matter. A
stretch of any length works; a tree takes some 500 bytes for each of its words. Other
columns pass through, but for those named like the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, ship, slices, texts_of, without

#: Least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of a window that recurs inside each run (see above; at most a third of LEAST_WORDS).
WINDOW = 8
#: Words after which a pair of trees takes no further stretch.
TREE_WORDS = 30_000
#: Entries of the Euler tour that are scanned at once; minima of blocks are tabled.
BLOCK = 16

RUN = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]
)


class Runs(NamedTuple):
    """Runs by number of their text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class Tree:
    """The suffix tree of a list of symbols below ``width`` whose last one occurs once."""

    def __init__(self, symbols: list[int], width: int):
        self.width = width
        self.grow(symbols)
        self.walk()

    def grow(self, symbols: list[int]) -> None:
        """Ukkonen's construction: symbol by symbol, leaves grow by themselves.

        ``node``, ``edge`` and ``depth`` tell where the longest suffix that is no leaf yet
        ends: so many symbols down the edge of ``node`` that starts like ``symbols[edge]``.
        """
        size, width = len(symbols), self.width
        first, stop, link = [0], [0], [0]
        below: dict[int, int] = {}
        leaves = []
        node = edge = depth = waiting = 0
        for place, symbol in enumerate(symbols):
            waiting += 1
            made = 0
            while waiting:
                if not depth:
                    edge = place
                key = node * width + symbols[edge]
                child = below.get(key)
                if child is None:
                    below[key] = len(first)
                    leaves.append(len(first))
                    first.append(place)
                    stop.append(size)
                    link.append(0)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    begin = first[child]
                    span = stop[child] - begin
                    if depth >= span:
                        node = child
                        edge += span
                        depth -= span
                        continue
                    if symbols[begin + depth] == symbol:
                        if made:
                            link[made] = node
                        depth += 1
                        break
                    inner = len(first)
                    middle = begin + depth
                    below[key] = inner
                    first += (begin, place)
                    stop += (middle, size)
                    link += (0, 0)
                    leaves.append(inner + 1)
                    first[child] = middle
                    below[inner * width + symbols[middle]] = child
                    below[inner * width + symbol] = inner + 1
                    if made:
                        link[made] = inner
                    made = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif depth:
                    depth -= 1
                    edge = place - waiting + 1
        spans = np.array(stop, dtype=np.int64) - np.array(first, dtype=np.int64)
        keys = np.fromiter(below.keys(), dtype=np.int64, count=len(below))
        children = np.fromiter(below.values(), dtype=np.int64, count=len(below))
        order = np.argsort(keys)
        self.parents, self.symbols = np.divmod(keys[order], width)
        self.children, self.spans = children[order], spans
        self.leaves = np.array(leaves, dtype=np.int64)

    def walk(self) -> None:
        """The Euler tour: string depths in the order of visits, and each leaf's visit."""
        nodes = len(self.spans)
        begin = np.searchsorted(self.parents, np.arange(nodes + 1))
        child, ends = self.children.tolist(), begin[1:].tolist()
        following, spans = begin[:-1].tolist(), self.spans.tolist()
        depth, seen, above = [0] * nodes, [0] * nodes, [-1] * nodes
        tour = [0]
        node = 0
        while node >= 0:
            turn = following[node]
            if turn < ends[node]:
                following[node] = turn + 1
                next_node = child[turn]
                above[next_node] = node
                depth[next_node] = depth[node] + spans[next_node]
                seen[next_node] = len(tour)
                tour.append(depth[next_node])
                node = next_node
            else:
                node = above[node]
                if node >= 0:
                    tour.append(depth[node])
        self.visits = np.array(seen, dtype=np.int64)[self.leaves]
        size = -(-len(tour) // BLOCK) * BLOCK
        depths = np.full(size, np.iinfo(np.int32).max, dtype=np.int32)
        depths[: len(tour)] = tour
        blocks = depths.reshape(-1, BLOCK)
        self.depths = depths
        self.to_here = np.minimum.accumulate(blocks, axis=1).ravel()
        self.from_here = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        reach = 1
        while 2 * reach <= len(self.table[0]):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-reach], row[reach:]))
            reach *= 2

    def ranks(self, parting: int) -> np.ndarray:
        """Ranks of the suffixes if symbols compare the other way round.

        Symbols below ``parting`` stay the smallest, as the end of a text is.
        """
        back = np.where(self.symbols < parting, self.symbols, self.width + parting - self.symbols)
        order = np.lexsort((back, self.parents))
        begin = np.searchsorted(self.parents, np.arange(len(self.spans) + 1)).tolist()
        child = self.children[order][::-1].tolist()
        total = len(child)
        found, stack = [], [0]
        while stack:
            node = stack.pop()
            low, high = begin[node], begin[node + 1]
            if low == high:
                found.append(node)
            else:  # last child first, so that the first one is taken next
                stack += child[total - high : total - low]
        places = np.empty(len(self.spans), dtype=np.int64)
        places[found] = np.arange(len(found))
        return places[self.leaves]

    def extension(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at two different places have in common, pair by pair."""
        a, b = self.visits[one], self.visits[other]
        low, high = np.minimum(a, b), np.maximum(a, b)
        left, right = low // BLOCK, high // BLOCK
        found = np.minimum(self.from_here[low], self.to_here[high])
        inside = np.flatnonzero(left == right)
        if len(inside):
            window = np.minimum(low[inside, None] + np.arange(BLOCK), high[inside, None])
            found[inside] = self.depths[window].min(axis=1)
        gaps = right - left - 1
        levels = np.frexp(np.maximum(gaps, 1))[1] - 1
        for level in np.unique(levels[gaps > 0]):
            at = np.flatnonzero((levels == level) & (gaps > 0))
            row = self.table[level]
            between = np.minimum(row[left[at] + 1], row[right[at] - (1 << int(level))])
            found[at] = np.minimum(found[at], between)
        return found.astype(np.int64)


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """The next place of smaller rank for each place; the last one names itself."""
    values = ranks.tolist()
    found = list(range(len(values)))
    open_places: list[int] = []
    for place, value in enumerate(values):
        while open_places and values[open_places[-1]] > value:
            found[open_places.pop()] = place
        open_places.append(place)
    return np.array(found, dtype=np.int64)


def runs_of_symbols(symbols: np.ndarray, parting: int) -> tuple[np.ndarray, ...]:
    """Starts, lengths and periods of all runs between the symbols below ``parting``.

    Such symbols occur once each, and the list begins and ends with one.
    """
    size, width = len(symbols), int(symbols.max()) + 2
    ahead = Tree(symbols.tolist(), width)
    back = Tree(symbols[::-1].tolist(), width)
    places = np.flatnonzero(symbols >= parting)
    found = []
    for ranks in (np.argsort(np.argsort(ahead.visits)), ahead.ranks(parting)):
        ends = next_smaller(ranks)[places]
        period = ends - places
        reach = places + period
        right = ahead.extension(places, reach)
        left = back.extension(size - places, size - reach)
        length = left + period + right
        held = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([(places - left)[held], length[held], period[held]], axis=1))
    return tuple(np.unique(np.concatenate(found), axis=0).T)


def stretches(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the stretches of words that can hold a run, none across texts."""
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    windows = len(hashes) - WINDOW + 1
    none = np.empty(0, dtype=np.int64)
    if windows < 1:
        return none, none
    sums = np.zeros(windows, dtype=np.uint64)
    for step in range(WINDOW):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + hashes[step : step + windows]
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(text[:windows] == text[WINDOW - 1 :])
    sums = (sums[whole] ^ (sums[whole] >> np.uint64(32))) + text[whole].astype(
        np.uint64
    ) * np.uint64(0xD1B54A32D192ED03)
    again = whole[pd.Series(sums).duplicated(keep=False).to_numpy()]
    if not len(again):
        return none, none
    change = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    inside = (np.cumsum(change) > 0).astype(np.int8)
    inside[-1] = 0
    edges = np.diff(inside, prepend=np.int8(0))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # Stretches of neighbouring texts may touch: cut them where a text ends.
    borders = ends[:-1][(inside[ends[:-1] - 1] > 0) & (inside[ends[:-1]] > 0)] if len(ends) > 1 else none
    borders = np.unique(borders)
    starts = np.sort(np.concatenate([starts, np.setdiff1d(borders, starts)]))
    stops = np.sort(np.concatenate([stops, np.setdiff1d(borders, stops)]))
    long = stops - starts >= LEAST_WORDS
    return starts[long], stops[long]


def runs_of_texts(words: list[bytes], counts: np.ndarray) -> Runs:
    """All runs of texts given as their words in a row and numbers of words."""
    starts, stops = stretches(words, counts)
    offsets = np.cumsum(counts) - counts
    rows = []
    at = 0
    while at < len(starts):
        group = [at]
        total = int(stops[at] - starts[at])
        at += 1
        while at < len(starts) and total + int(stops[at] - starts[at]) <= TREE_WORDS:
            total += int(stops[at] - starts[at])
            group.append(at)
            at += 1
        parting = len(group) + 1
        pieces, origin = [np.zeros(1, dtype=np.int64)], [-1]
        taken: list[bytes] = []
        for number in group:
            taken += words[starts[number] : stops[number]]
        column = np.empty(len(taken), dtype=object)
        column[:] = taken
        codes = pd.factorize(column)[0].astype(np.int64) + parting
        done = 0
        for mark, number in enumerate(group, start=1):
            size = int(stops[number] - starts[number])
            pieces += [codes[done : done + size], np.array([mark])]
            origin += [*range(starts[number], stops[number]), -1]
            done += size
        start, length, period = runs_of_symbols(np.concatenate(pieces), parting)
        rows.append((np.array(origin, dtype=np.int64)[start], length, period))
    if not rows:
        empty = np.empty(0, dtype=np.int64)
        return Runs(empty, empty, empty, empty)
    start, length, period = (np.concatenate(column) for column in zip(*rows, strict=True))
    text = np.searchsorted(np.cumsum(counts), start, side="right")
    return Runs(text, start - offsets[text], length, period)


def collapsed(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if start:
        drop = np.zeros(len(words) + 1, dtype=np.int64)
        first, stop = np.array(start), np.array(start) + np.array(length)
        np.add.at(drop, first + np.array(period), 1)
        np.add.at(drop, stop, -1)
        kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0)
        words = [words[place] for place in kept.tolist()]
    return b" ".join(words)


def with_runs(documents: DataFrame) -> DataFrame:
    """All rows and columns, with the results of ``text`` as further columns.

    ``runs`` is an array of (start, length, period), by start, then period; ``collapsed``
    the words that are left if each run keeps its first period, joined by one space.
    """
    documents = without(documents, "runs", "collapsed")
    schema = T.StructType(
        [
            *documents.schema.fields,
            T.StructField("runs", T.ArrayType(RUN, False)),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            split = [text.split() for text in texts_of(batch, "text")]
            counts = np.array([len(words) for words in split], dtype=np.int64)
            found = runs_of_texts([word for words in split for word in words], counts)
            order = np.lexsort((found.period, found.start, found.text))
            found = Runs(*[column[order] for column in found])
            ends = np.searchsorted(found.text, np.arange(len(split) + 1))
            left = []
            for number, words in enumerate(split):
                own = slice(ends[number], ends[number + 1])
                run = [column[own].tolist() for column in found[1:]]
                left.append(collapsed(words, *run))
            run = pa.StructArray.from_arrays(
                [pa.array(column) for column in found[1:]],
                fields=[pa.field(name, pa.int64(), False) for name in RUN.fieldNames()],
            )
            runs = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), run, pa.list_(pa.field("element", run.type, False))
            )
            columns = [batch.column(i) for i in range(batch.num_columns)]
            plain = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, runs, plain], names=schema.fieldNames())

    return ship(documents).mapInArrow(find, schema)


def with_planted_tails(documents: DataFrame) -> DataFrame:
    """The documents of the digest query: a tenth of them ends in a periodic tail.

    With h the unsigned crc32 of the decimal doc_id and g its tenth: where h ends in 0 and
    the text has n words, word i from a = g % n on becomes word a + (i - a) % p of the text,
    with p = 1 + (n - a) div (3 + g % 8). Such texts are joined by single spaces.
    """
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = documents.where(draw % 10 == 0)
    words = planted.withColumn(
        "_words", F.expr(rf"regexp_extract_all(coalesce(text, ''), '{regex_literal(WORD)}', 0)")
    )
    words = words.withColumn("_g", F.floor(draw / 10)).withColumn("_n", F.size("_words"))
    words = words.withColumn("_a", F.expr("int(_g % greatest(_n, 1))"))
    words = words.withColumn("_p", F.expr("int(1 + (_n - _a) div (3 + _g % 8))"))
    text = F.expr(
        "if(_n = 0, text, array_join(concat(slice(_words, 1, _a), "
        "transform(sequence(_a, greatest(_n, 1) - 1), i -> _words[_a + (i - _a) % _p])), ' '))"
    )
    tailed = words.withColumn("text", text).select(*documents.columns)
    return documents.where((draw % 10 != 0) | draw.isNull()).unionByName(tailed)


def regex_literal(pattern: str) -> str:
    """A pattern inside a SQL literal."""
    return pattern.replace("\\", "\\\\")


def strongest() -> Column:
    """The run of greatest length by period; of equals the first."""
    return F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(best, run) -> if(best is null or run.length * best.period > best.length * run.period, "
        "run, best))"
    )


def run_digests(documents: DataFrame) -> DataFrame:
    """One row per document: number of runs, the strongest one, digests of runs and rest."""
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    found = with_runs(documents.select("doc_id", "text")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        strongest().alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id",
        "n_runs",
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
