"""Toxicity by class-conditional Kneser-Ney models.

Words count by their first STEM letters, so that forms of one rare stem add up. Two models,
of toxic and of ordinary texts, give each word a probability after the word before it:
discounted counts of word pairs (documents that hold the pair), then of the class's
continuation counts (number of distinct words before a word), then the continuation counts of
all documents, labelled or not, then an even share. Distinct words are those of a document,
added up over documents: distinct ones of a whole class or corpus would take a row of every
pair there, which went through a shuffle of 1.7 times the input on 0.5 GB, and growing. The discount is the usual constant and
what the other class and chance explain: a count c against c' in the other class, which has
1 / ratio times as many documents, keeps
c - margin * ratio * c' - deviations * sqrt(max(ratio, 1) * (c + c')) - 0.75, or nothing. It
has no other bar, so weight falls smoothly with evidence. A continuation count keeps the
share that its documents keep, but no more than chance leaves of it; what neither class
claims of a word's contexts is its shared count. So expressions that are rare, or common in
both classes, rest on the shared counts and are equally likely in both, and evidence comes
from expressions that set a class apart (a constant discount alone found half of the toxic
documents of the test data: the mix of languages in a class drowned its expressions). A document's
evidence is the difference of log-likelihoods per word; a logistic curve, fitted on documents
that the counts have not seen, makes it a score.

Counts are exact and of all labelled rows that may be learned from, contexts of all texts.
One pass over all texts counts words, one over the labelled texts pairs; a task adds up
before it shuffles. Only the curve is
fitted on a bounded sample (``Settings.calibration`` documents, chosen by hash). Of the model
only expressions that set a class apart need rows, as all others have equal ratios: up to
``Settings.expressions`` they are broadcast, more are joined by key, with equal results.
Every document is scored, over its whole text.

Defined results: a null or empty text has the evidence of a word that nobody knows.
A doc_id with several labels counts as toxic if one says so; labels other than 0 and 1, and
labels without document, are ignored. With labels of one class only, or none, every score is
0. Repeated rows get equal scores; other columns pass through, but for one named like the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import coded_words, cut, mixed, ship, slices, small, stored, texts_of, without

STEP = np.uint64(0x9E3779B97F4A7C15)
EDGE = ".,;:!?'\"()-*#$%&|<>"
DISCOUNT = 0.75
#: Letters of a word that count.
STEM = 5
CLASSES = ("toxic", "ordinary")
#: Labelled ids that are broadcast; more are joined by a shuffle.
LABELS = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Documents for the curve, expressions of a model that is broadcast, weights of the discount."""

    calibration: int = 8_000
    expressions: int = 200_000
    margin: float = 3.0
    deviations: float = 1.5


@dataclass
class Model:
    """Class probabilities (columns: toxic, ordinary) by sorted keys, or frames to join by key.

    ``neutral`` weighs the shared counts of words that are no keys.
    """

    neutral: np.ndarray
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    word_p: np.ndarray = field(default_factory=lambda: np.ones((0, 2)))
    backoff: np.ndarray = field(default_factory=lambda: np.ones((0, 2)))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_p: np.ndarray = field(default_factory=lambda: np.ones((0, 2)))
    frames: tuple[DataFrame, DataFrame] | None = None
    slope: float = 1.0
    offset: float = 0.0

    @property
    def unknown(self) -> float:
        """Evidence of a word that nobody knows, and so of a text without words."""
        return float(np.log(self.neutral[0] / self.neutral[1]))

    @classmethod
    def by_key(cls, words: DataFrame, pairs: DataFrame, neutral: np.ndarray) -> Model:
        return cls(neutral, frames=(words, pairs))

    @classmethod
    def on_driver(cls, words: DataFrame, pairs: DataFrame, neutral: np.ndarray) -> Model:
        words, pairs = words.toPandas(), pairs.toPandas()
        keys = words["word"].to_numpy(np.int64).view(np.uint64)
        before, after = (pairs[c].to_numpy(np.int64).view(np.uint64) for c in ("before", "word"))
        pair_keys = mixed(before * STEP + after)
        at, pair_at = np.argsort(keys), np.argsort(pair_keys)

        def values(table: pd.DataFrame, kind: str) -> np.ndarray:
            return table[[f"{c}_{kind}" for c in CLASSES]].to_numpy(float)

        return cls(
            neutral, keys[at], values(words, "p")[at], values(words, "backoff")[at],
            pair_keys[pair_at], values(pairs, "p")[pair_at],
        )


def crc(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def held_out(doc_id: str = "doc_id") -> Column:
    return crc(doc_id) % 5 == 0


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stems of all texts in a row as codes, the hash of each code, words per text."""
    codes, distinct, counts = coded_words(texts)
    plain = [word.decode("utf-8", "replace").lower() for word in distinct]
    plain = [(word.strip(EDGE) or word)[:STEM] for word in plain]
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in plain], dtype=np.uint64)
    merged, unique = pd.factorize(hashes)
    return (merged[codes] if len(codes) else codes), unique.astype(np.uint64), counts


def pair_codes(codes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of neighbouring words within a text, as one number, and the text of each."""
    text = np.repeat(np.arange(len(counts)), counts)
    inside = text[1:] == text[:-1]
    return (codes[:-1] * np.int64(size) + codes[1:])[inside], text[1:][inside]


def labelled(labels: DataFrame) -> DataFrame:
    """One row (doc_id, toxic) per labelled document that may be learned from."""
    rows = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    return rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def with_roles(labels: DataFrame) -> DataFrame:
    """Labelled documents with a role: count or, a fifth of the ids, curve."""
    return labelled(labels).withColumn(
        "role", F.when(crc() % 5 == 1, F.lit("curve")).otherwise(F.lit("count"))
    )


def curve_sample(marks: DataFrame, documents: DataFrame, settings: Settings) -> DataFrame:
    """Texts to fit the curve on: columns text, toxic; a bounded sample.

    Of the documents that no class has counted, where those have both classes.
    """
    sizes = {
        (r["role"], r["toxic"]): r["n"]
        for r in marks.groupBy("role", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    role = "curve" if {("curve", 0), ("curve", 1)} <= set(sizes) else "count"
    share = min(1.0, settings.calibration / max(sizes.get((role, 0), 0) + sizes.get((role, 1), 0), 1))
    chance = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = marks.where((F.col("role") == role) & (chance < share)).select("doc_id", "toxic")
    # About ``calibration`` ids at most, whatever the size of the tables.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return stored(texts.select("text", "toxic"), "toxicity-curve")


class Pairs:
    """Word pairs of the texts of a batch, each pair once for a text."""

    def __init__(self, batch: pa.RecordBatch):
        codes, self.hashes, counts = hashed_words(texts_of(batch, "text"))
        self.marks = np.asarray(pc.fill_null(batch.column("toxic"), -1), dtype=np.int64)
        size, texts = max(len(self.hashes), 1), len(counts)
        pairs, text = pair_codes(codes, counts, size)
        at, unique = pd.factorize(pairs)
        once = pd.unique(at.astype(np.int64) * texts + text)
        #: Distinct pairs by number: codes of both words.
        self.before, self.word = unique // size, unique % size
        #: The pairs of each text: number of the pair and class of the text.
        self.pair, self.mark = once // texts, self.marks[once % texts]
        text = np.repeat(np.arange(texts), counts)
        once = pd.unique(codes * np.int64(texts) + text)
        #: The words of each text.
        self.single, self.single_mark = once // texts, self.marks[once % texts]

    def of_class(self, mark: int, values: np.ndarray | None = None) -> np.ndarray:
        """Number of texts of a class for each pair, or sum over pairs by ``values``."""
        taken = self.pair[self.mark == mark]
        if values is None:
            return np.bincount(taken, minlength=len(self.before)).astype(np.int64)
        return np.bincount(values[taken], minlength=len(self.hashes)).astype(np.int64)


#: Per word: documents of a class, and pairs of documents that start or end with the word.
COUNTS = ["toxic", "ordinary", "toxic_seen", "ordinary_seen", "toxic_before", "ordinary_before", "shared_before"]


def word_counts(rows: DataFrame) -> DataFrame:
    """Columns word and ``COUNTS`` over texts, labelled (``toxic`` 0 or 1) or not."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = Pairs(batch)
            if not len(own.hashes):
                continue
            every = np.arange(len(own.hashes))
            found = {"shared_before": np.bincount(own.word[own.pair], minlength=len(every)).astype(np.int64)}
            for c, mark in zip(CLASSES, (1, 0)):
                held = own.single[own.single_mark == mark]
                found[c] = np.bincount(held, minlength=len(every)).astype(np.int64)
                found[f"{c}_seen"] = own.of_class(mark, own.before)
                found[f"{c}_before"] = own.of_class(mark, own.word)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.hashes.view(np.int64)), *[pa.array(found[name]) for name in COUNTS]],
                ["word", *COUNTS],
            )

    kinds = ", ".join(f"{name} long" for name in COUNTS)
    counted = ship(rows).select("text", "toxic").mapInArrow(count, f"word long, {kinds}")
    return counted.groupBy("word").agg(*[F.sum(name).alias(name) for name in COUNTS])


def pair_counts(rows: DataFrame) -> DataFrame:
    """Columns before, word, toxic, ordinary over labelled texts: documents with each pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = Pairs(batch)
            signed = own.hashes.view(np.int64)
            # Rows of a word stand together, so that shuffle files compress them.
            order = np.argsort(own.word, kind="stable")
            arrays = [signed[own.before], signed[own.word], own.of_class(1), own.of_class(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[order]) for values in arrays], ["before", "word", *CLASSES]
            )

    schema = "before long, word long, toxic long, ordinary long"
    counted = ship(rows).select("text", "toxic").mapInArrow(count, schema)
    return counted.groupBy("before", "word").agg(*[F.sum(c).alias(c) for c in CLASSES])


def excess(own: str, other: str, ratio: float, settings: Settings) -> Column:
    """What is left of a class's documents after the discount.

    ``ratio`` is own documents per document of the other class; under chance alone the
    difference own - ratio * other has the variance ratio * (own + other); the counts of the
    smaller class have their own chance, as if the other were no larger.
    """
    own, other = F.col(own), F.col(other)
    chance = settings.deviations * F.sqrt(max(ratio, 1.0) * (own + other))
    return F.greatest(own - settings.margin * ratio * other - chance - DISCOUNT, F.lit(0.0))


def fitted(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The model; None without labels of both classes."""
    marks = cut(with_roles(labels))
    counted = small(marks.where("role = 'count'").select("doc_id", "toxic"), LABELS)
    texts = documents.select("doc_id", "text")
    learned = texts.join(counted, "doc_id")
    sizes = {
        r["toxic"]: r["n"]
        for r in learned.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not sizes.get(0) or not sizes.get(1):
        return None
    ratio = sizes[1] / sizes[0]
    left = {"toxic_left": excess("toxic", "ordinary", ratio, settings),
            "ordinary_left": excess("ordinary", "toxic", 1 / ratio, settings)}
    marked = texts.join(counted, "doc_id", "left")

    # Continuation counts, and what the discount leaves of them: the same share as of documents,
    # and no more than chance leaves of the contexts themselves.
    words = word_counts(marked).where("shared_before > 0").withColumns(left)
    part = {c: F.when(F.col(c) > 0, F.col(f"{c}_left") / F.col(c)).otherwise(0.0) for c in CLASSES}

    def sure(contexts: str) -> Column:
        found = F.col(contexts)
        return F.greatest(found - settings.deviations * F.sqrt(found) - DISCOUNT, F.lit(0.0))

    words = words.select(
        "word", "toxic_before", "ordinary_before", "toxic_seen", "ordinary_seen",
        *[F.least(part[c] * F.col(f"{c}_before"), sure(f"{c}_before")).alias(f"{c}_mass") for c in CLASSES],
        # What neither class claims of the contexts in all documents.
        (F.col("shared_before") * (1 - F.greatest(*part.values()))).alias("shared"),
    )
    words = stored(words, "toxicity-words")
    totals = words.agg(
        *[F.sum(f"{c}_{k}").alias(f"{c}_{k}") for c in CLASSES for k in ("before", "mass")],
        F.sum("shared").alias("s"), F.count(F.lit(1)).alias("v"),
    ).first()
    if not totals["toxic_before"] or not totals["ordinary_before"]:
        return None
    neutral = np.array([1 - totals[f"{c}_mass"] / totals[f"{c}_before"] for c in CLASSES])
    whole = totals["s"] + DISCOUNT * (totals["v"] + 1)

    apart = pair_counts(learned).withColumns(left).where("toxic_left + ordinary_left > 0")
    apart = cut(apart.select("before", "word", "toxic_left", "ordinary_left"))

    # Pairs that set a class apart have rows; the others rest on the words.
    seen = words.select(F.col("word").alias("before"), *[f"{c}_seen" for c in CLASSES])
    kept_pairs = stored(
        seen.join(small(apart, LABELS), "before").select(
            "before", "word",
            *[(F.col(f"{c}_left") / F.greatest(f"{c}_seen", F.lit(1))).alias(f"{c}_p") for c in CLASSES],
        ),
        "toxicity-kept-pairs",
    )
    backoff = kept_pairs.groupBy(F.col("before").alias("word")).agg(
        *[(1 - F.sum(f"{c}_p")).alias(f"{c}_backoff") for c in CLASSES]
    )
    # A word with no mass of its own has equal shared counts in both classes: its ratio is that
    # of the neutral weights, and it needs a row only behind or before a kept pair.
    shared = (F.col("shared") + DISCOUNT) / float(whole)
    ends = kept_pairs.select("word").distinct().withColumn("end", F.lit(True))
    kept_words = (
        words.join(ends, "word", "left").join(backoff, "word", "full")
        .where("end or toxic_mass > 0 or ordinary_mass > 0 or toxic_backoff is not null")
        .select(
            "word",
            *[
                F.coalesce(
                    F.col(f"{c}_mass") / float(totals[f"{c}_before"]) + float(weight) * shared,
                    F.lit(float(weight)),
                ).alias(f"{c}_p")
                for c, weight in zip(CLASSES, neutral)
            ],
            *[F.coalesce(f"{c}_backoff", F.lit(1.0)).alias(f"{c}_backoff") for c in CLASSES],
        )
    )
    kept_words = stored(kept_words, "toxicity-kept-words")
    if kept_words.count() + kept_pairs.count() > settings.expressions:
        model = Model.by_key(kept_words, kept_pairs, neutral)
    else:
        model = Model.on_driver(kept_words, kept_pairs, neutral)
    calibrate(model, curve_sample(marks, documents, settings))
    return model


def found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among sorted keys, -1 if it is none of them."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def evidence(texts: list[bytes], model: Model) -> np.ndarray:
    """Toxic minus ordinary log-likelihood per word of each text; see ``Model.unknown``."""
    codes, hashes, counts = hashed_words(texts)
    total = np.where(counts > 0, 0.0, model.unknown)
    if not len(codes):
        return total
    at = found(model.words, hashes)
    single = np.where(at[:, None] >= 0, model.word_p[at] if len(model.words) else model.neutral, model.neutral)
    weight = np.where(at[:, None] >= 0, model.backoff[at] if len(model.words) else 1.0, 1.0)
    starts = np.cumsum(counts) - counts
    full = counts > 0
    first = single[codes[starts[full]]]
    total[full] = np.log(first[:, 0] / first[:, 1])
    pairs, text = pair_codes(codes, counts, len(hashes))
    if len(pairs):
        place, unique = pd.factorize(pairs)
        before, after = unique // len(hashes), unique % len(hashes)
        at = found(model.pairs, mixed(hashes[before] * STEP + hashes[after]))
        own = np.where(at[:, None] >= 0, model.pair_p[at] if len(model.pairs) else 0.0, 0.0)
        likely = own + weight[before] * single[after]
        ratio = np.log(likely[:, 0] / likely[:, 1])
        total += np.bincount(text, weights=ratio[place], minlength=len(texts))
    return total / np.maximum(counts, 1)


def keyed_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Rows with ``_toxicity_evidence``, for a model too large to broadcast.

    Word pairs meet the model by key and are summed for each text, named by its digest; equal
    texts add to their sum and to their words alike.
    """
    words, pairs = model.frames
    schema = "_toxicity_key string, before long, word long, times long"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, hashes, counts = hashed_words(texts_of(batch, "text"))
            if not len(codes):
                continue
            named = np.array(batch.column("_toxicity_key").to_pylist(), dtype=object)
            starts, full = np.cumsum(counts) - counts, np.flatnonzero(counts)
            found, text = pair_codes(codes, counts, len(hashes))
            at, unique = pd.factorize(found)
            each, times = np.unique(at.astype(np.int64) * len(counts) + text, return_counts=True)
            place, signed = unique[each // len(counts)], hashes.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([named[full], named[each % len(counts)]]), pa.string()),
                    pa.array([None] * len(full) + signed[place // len(hashes)].tolist(), pa.int64()),
                    pa.array(np.concatenate([signed[codes[starts[full]]], signed[place % len(hashes)]])),
                    pa.array(np.concatenate([np.ones(len(full), np.int64), times])),
                ],
                names=["_toxicity_key", "before", "word", "times"],
            )

    rows = rows.withColumn("_toxicity_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = ship(rows).select("_toxicity_key", "text").mapInArrow(parts, schema)
    behind = words.select(F.col("word").alias("before"), *[f"{c}_backoff" for c in CLASSES])
    single = words.select("word", *[F.col(f"{c}_p").alias(f"{c}_single") for c in CLASSES])
    found = found.join(pairs, ["before", "word"], "left").join(behind, "before", "left").join(single, "word", "left")
    likely = [
        F.coalesce(f"{c}_p", F.lit(0.0))
        + F.coalesce(f"{c}_backoff", F.lit(1.0)) * F.coalesce(f"{c}_single", F.lit(float(weight)))
        for c, weight in zip(CLASSES, model.neutral)
    ]
    per_text = found.groupBy("_toxicity_key").agg(
        (F.sum(F.col("times") * F.log(likely[0] / likely[1])) / F.sum("times")).alias("_toxicity_evidence")
    )
    joined = rows.join(per_text, "_toxicity_key", "left").drop("_toxicity_key")
    return joined.withColumn("_toxicity_evidence", F.coalesce("_toxicity_evidence", F.lit(model.unknown)))


def curve(model: Model) -> Column:
    """Score by the column ``_toxicity_evidence``."""
    x = F.col("_toxicity_evidence") * model.slope + model.offset
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(700.0)), F.lit(-700.0))))


def calibrate(model: Model, rows: DataFrame) -> None:
    """Fit slope and offset of the logistic curve by Newton steps on the bounded sample."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict(
                {"x": evidence(texts_of(batch, "text"), model), "toxic": batch.column("toxic")}
            )

    if model.frames:
        table = keyed_evidence(rows, model).select(F.col("_toxicity_evidence").alias("x"), "toxic").toPandas()
    else:
        table = ship(rows).select("text", "toxic").mapInArrow(measure, "x double, toxic int").toPandas()
    x, y = table["x"].to_numpy(float), table["toxic"].to_numpy(float)
    scale = float(np.std(x)) or 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset = float(beta[0] / scale), float(beta[1])


def scores(texts: list[bytes], model: Model | None) -> np.ndarray:
    """Score of each text, from 0 to 1."""
    if model is None:
        return np.zeros(len(texts))
    x = model.slope * evidence(texts, model) + model.offset
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns, with a column ``toxicity`` in place of any of that name."""
    documents = without(documents, "toxicity")
    if model is not None and model.frames:
        return keyed_evidence(documents, model).withColumn("toxicity", curve(model)).drop("_toxicity_evidence")
    schema = T.StructType([*documents.schema.fields, T.StructField("toxicity", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = [batch.column(i) for i in range(batch.num_columns)]
            values = pa.array(scores(texts_of(batch, "text"), model))
            yield pa.RecordBatch.from_arrays([*columns, values], names=schema.fieldNames())

    return ship(documents).mapInArrow(score, schema)


def ordinary(documents: DataFrame, model: Model | None, bar: float = 0.5) -> DataFrame:
    """The rows whose score is below the bar, with their columns as they are."""
    if model is not None and model.frames:
        return keyed_evidence(documents, model).where(curve(model) < bar).drop("_toxicity_evidence")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(scores(texts_of(batch, "text"), model) < bar))

    return ship(documents).mapInArrow(keep, documents.schema)
