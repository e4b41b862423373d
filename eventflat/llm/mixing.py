"""Mixing sources to target weights.

Sources share a total by weight, none above a multiple of its own size; what is over goes
to the others by weight. A source takes whole epochs of its documents first; the rest of
its target is filled by weighted sampling without replacement: a document's key is
-ln(u) / quality weight (Efraimidis and Spirakis), documents are taken by ascending key
while the middle of a document lies within the target, so a source misses its target by
half a document at most.

Prefix sums are made in two steps: sums by key range within a source, then by document in
the one range in which the target falls. No task orders a whole source.

Defined results: a null source is a source of its own, after the others. A null text has
size 0, and takes 0 words. Rows that repeat a doc_id share its key and are taken or left
together. An empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
#: Key ranges per source.
RANGES = 1024
#: Sources whose targets may be broadcast; more are joined.
FEW_SOURCES = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """From 0.25 to 1: less for texts full of symbols."""
    plain = F.length(F.translate(text, "#*$%&|<>", ""))
    share = F.coalesce(plain / F.greatest(F.length(text), F.lit(1)), F.lit(1.0))
    return F.lit(0.25) + F.lit(0.75) * share * share


def uniform(doc_id: Column, seed: int) -> Column:
    """In (0, 1), from 52 bits of a digest of the id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def keyed(documents: DataFrame, seed: int = 17) -> DataFrame:
    """Columns doc_id, source, size, key, range: keys ascend with ranges."""
    return with_keys(documents, seed, words(F.col("text")).alias("size"))


def with_keys(documents: DataFrame, seed: int, *more: Column) -> DataFrame:
    rows = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        *more,
        (-F.ln(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"))).alias("key"),
    )
    spread = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * RANGES).cast("int")
    return rows.withColumn("range", F.least(spread, F.lit(RANGES - 1)))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Columns source, source_size, target, from one row (source, source_size) per source.

    Sources that the common rate fills to their cap are those with the least cap per weight:
    over sources in that order, the rate after capping the first k comes from running sums.
    The windows are over sources, one row each.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_at", (F.row_number().over(by_name) - 1) % len(weights))
    ranked = ranked.withColumns({"_w": F.get(cycle, F.col("_at").cast("int")), "_cap": F.col("source_size") * F.lit(most)})
    order = Window.orderBy((F.col("_cap") / F.col("_w")), F.asc_nulls_last("source"))
    through = order.rowsBetween(Window.unboundedPreceding, 0)
    all_of = Window.partitionBy()
    summed = ranked.select(
        "*",
        (F.sum("source_size").over(all_of) * F.lit(share)).alias("_total"),
        F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_capped"),
        (F.sum("_w").over(all_of) - F.sum("_w").over(through) + F.col("_w")).alias("_left"),
    )
    rated = summed.withColumn("_rate", (F.col("_total") - F.col("_capped")) / F.col("_left"))
    # The first source in order that its rate does not fill sets the rate of all behind it.
    open_rate = F.when(F.col("_rate") * F.col("_w") <= F.col("_cap"), F.col("_rate"))
    rate = F.first(open_rate, ignorenulls=True).over(through)
    return rated.withColumn("_final", rate).select(
        "source",
        "source_size",
        F.when(F.col("_final").isNull(), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), F.col("_final") * F.col("_w")))
        .alias("target"),
    )


def cutoffs(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: target, whole epochs, and the last range, key and id that the rest takes."""
    plan = wanted.select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long").alias("epochs"),
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("end", F.sum("n").over(upto))
    p, q = plan.alias("p"), sums.alias("q")
    crossed = (
        p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("q.end") > F.col("p.rest")))
        .groupBy(F.col("p.source").alias("source"))
        .agg(F.min_by(F.struct("q.range", "q.end", "q.n", "p.rest"), "q.range").alias("c"))
        .select("source", F.col("c.range").alias("range"), (F.col("c.end") - F.col("c.n")).alias("before"), F.col("c.rest").alias("rest"))
    )
    crossed = cut(crossed)
    r, c = rows.alias("r"), crossed.alias("c")
    inside = r.join(c, (F.col("r.range") == F.col("c.range")) & F.col("r.source").eqNullSafe(F.col("c.source"))).select(
        "r.source", "r.key", "r.doc_id", "r.size", "c.before", "c.rest"
    )
    # Rows of one id are one entry: they have one key and go together.
    inside = inside.groupBy("source", "key", "doc_id").agg(
        F.sum("size").alias("size"), F.first("before").alias("before"), F.first("rest").alias("rest")
    )
    earlier = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    last = (
        inside.withColumn("middle", start + F.col("size") / 2)
        .where("middle <= rest")
        .groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    )
    found = plan.alias("p").join(crossed.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    found = found.join(last.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    return found.select(
        F.col("p.source").alias("_source"), "p.source_size", "p.target", "p.epochs",
        F.col("c.range").alias("_range"), F.col("l.last.key").alias("_key"), F.col("l.last.doc_id").alias("_doc_id"),
    )


def copies(ends: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows joined with their source's plan; column copies: how often the mix takes the row."""
    if ends.count() <= FEW_SOURCES:
        ends = F.broadcast(ends)
    joined = rows.join(ends, F.col("source").eqNullSafe(F.col("_source")))
    behind = (F.col("key") < F.col("_key")) | (
        (F.col("key") == F.col("_key"))
        & (F.col("doc_id").isNull() | F.coalesce(F.col("doc_id") <= F.col("_doc_id"), F.lit(False)))
    )
    taken = (
        F.when(F.col("_range").isNull() | (F.col("range") < F.col("_range")), True)
        .when(F.col("range") > F.col("_range"), False)
        .otherwise(F.coalesce(behind, F.lit(False)))
    )
    # Without a range that goes beyond the rest, the rest is the whole source, or nothing.
    full = F.col("_range").isNull() & (F.col("target") <= F.col("epochs") * F.col("source_size"))
    extra = F.when(full, 0).when(taken, 1).otherwise(0)
    return joined.withColumn("copies", (F.col("epochs") + extra).cast("long"))


def mixture(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17) -> DataFrame:
    """The documents that the mix takes, each as often as it takes them, with their columns."""
    rows = cut(keyed(documents, seed))
    sizes = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    ends = cut(cutoffs(rows, targets(sizes, weights, share, most)))
    whole = with_keys(documents, seed, F.struct("*").alias("_row"))
    taken = copies(ends, whole).where("copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*")


def mixed(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17) -> DataFrame:
    """Columns doc_id, size, source_size, target, taken (and source, copies) of every row."""
    rows = cut(keyed(documents, seed))
    sizes = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    ends = cut(cutoffs(rows, targets(sizes, weights, share, most)))
    return copies(ends, rows).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )
