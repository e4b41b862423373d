"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common short words are
compared with references of its language by Jensen-Shannon distance (square root of the
divergence in bits, 0 to 1). References are sums over all documents of the language.

Defined results: a null or empty text has no words, so the base rule fails it. A text below
the minimum length is not judged by that distance (null). ``lang`` counts by its primary
subtag of two or three letters; null and other values form one language of their own. A
language with too little reference text has no reference: its distances are null and the base
rules alone decide, as other languages say nothing about it. Where the references are made of
one language only, it has one at any size. Repeated rows each
get their own equal result; other columns pass through, but for one named like the result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import coded_words, cut, kept_by_worker, ship, slices, texts_of, without

#: Symbols that the base rules count.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "foreign", "digit", "space", "line", "stop", "symbol", "other")
LONG, SHORT = "long words", "other short words"

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("class_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Rules:
    """Thresholds and minimum lengths. A short word has at most ``short`` letters."""

    common: int = 64
    short: int = 5
    least_chars: int = 200
    least_words: int = 50
    least_reference_words: int = 5_000
    most_class_distance: float = 0.25
    most_word_distance: float = 0.47


@kept_by_worker(1)
def class_table() -> np.ndarray:
    """Class of each code point."""
    table = np.full(0x110000, CLASSES.index("other"), dtype=np.uint8)
    for code in range(0x30000):
        mark = chr(code)
        kind = unicodedata.category(mark)
        if mark == "\n":
            name = "line"
        elif mark.isspace():
            name = "space"
        elif kind[0] in "LM":
            name = "foreign" if code > 127 else "upper" if kind == "Lu" else "lower"
        elif kind[0] == "N":
            name = "digit"
        elif mark in ".,;:!?'\"()-" or 0x2010 <= code <= 0x201F or 0x3000 < code < 0x3003:
            name = "stop"
        elif code < 128:
            name = "symbol"
        else:
            continue
        table[code] = CLASSES.index(name)
    return table


def class_counts(texts: list[bytes]) -> np.ndarray:
    """Texts by classes: number of characters."""
    table, width = class_table(), len(CLASSES)
    found = np.zeros((len(texts), width), dtype=np.int64)
    for place, text in enumerate(texts):
        points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        found[place] = np.bincount(table[points], minlength=width)
    return found


@kept_by_worker(200_000)
def short_word(word: bytes, short: int) -> str | None:
    """A word without outer punctuation, lower-cased, if it is short and of letters only."""
    if len(word) > 4 * short + 8:
        return None
    plain = word.decode("utf-8", "replace").strip(".,;:!?'\"()-").lower()
    return plain if 0 < len(plain) <= short and plain.isalpha() else None


def repeated_words(codes: np.ndarray, counts: np.ndarray, width: int = 8) -> np.ndarray:
    """Words per text that stand in a window of ``width`` words found twice or more in it.

    Windows are numbered exactly by doubling: numbers of 1, 2, 4, 8 words, each from pairs.
    """
    total, starts = len(codes), np.concatenate([[0], np.cumsum(counts)])
    found = np.zeros(len(counts), dtype=np.int64)
    if total < width:
        return found
    ids, step = codes, 1
    while step < width:
        pairs = ids[: len(ids) - step] * np.int64(ids.max() + 1) + ids[step:]
        ids, step = pd.factorize(pairs)[0].astype(np.int64), 2 * step
    text = np.repeat(np.arange(len(counts)), counts)
    inside = text[: len(ids)] == text[width - 1 :]
    keys = pd.factorize(text[: len(ids)][inside] * np.int64(ids.max() + 1) + ids[inside])[0]
    twice = np.bincount(keys)[keys] > 1
    edge = np.zeros(total + 1, dtype=np.int64)
    at = np.flatnonzero(inside)[twice]
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[starts[1:]] - covered[starts[:-1]]


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / max(reference.sum(), 1)
    middle = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        x = np.broadcast_to(x, middle.shape)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / middle), 0).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def language(column: str = "lang"):
    found = F.lower(F.regexp_extract(F.col(column), r"^([A-Za-z]{2,3})([-_].*)?$", 1))
    return F.coalesce(found, F.lit(""))


def language_counts(documents: DataFrame, rules: Rules) -> DataFrame:
    """Rows (lang, kind, item, n) over all documents: classes and short words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}

        def rows() -> pa.RecordBatch:
            keys = list(sums)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
                + [pa.array([sums[k] for k in keys], pa.int64())],
                names=["lang", "kind", "item", "n"],
            )

        for batch in slices(batches, "text", class_table, short_word):
            texts = texts_of(batch, "text")
            langs, names = pd.factorize(np.array(batch.column("_lang").to_pylist(), dtype=object))
            classes = class_counts(texts)
            codes, distinct, counts = coded_words(texts)
            short = [short_word(word, rules.short) for word in distinct]
            known = np.array([word is not None for word in short], dtype=bool)
            by_word = np.repeat(langs, counts)
            for place, name in enumerate(names):
                own = classes[langs == place].sum(axis=0)
                for kind, n in zip(CLASSES, own):
                    sums[name, "class", kind] = sums.get((name, "class", kind), 0) + int(n)
                tally = np.bincount(codes[by_word == place], minlength=len(distinct))
                long = int(tally[~known].sum()) if len(distinct) else 0
                sums[name, "word", LONG] = sums.get((name, "word", LONG), 0) + long
                for at in np.flatnonzero((tally > 0) & known):
                    key = (name, "word", short[at])
                    sums[key] = sums.get(key, 0) + int(tally[at])
            if len(sums) > 200_000:
                yield rows()
                sums.clear()
        yield rows()

    counted = ship(documents).select("text", language().alias("_lang")).mapInArrow(
        count, "lang string, kind string, item string, n long"
    )
    return counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def language_references(documents: DataFrame, rules: Rules = Rules()) -> dict:
    """Reference histograms by language, on the driver.

    Bounded: languages are codes of two or three letters (18,252 at most), each with the
    classes, ``rules.common`` words and two rests.
    """
    counts = cut(language_counts(documents, rules))
    rest = F.col("kind").eqNullSafe("word") & (F.col("item") != LONG)
    totals = counts.groupBy("lang").agg(
        F.sum(F.when(F.col("kind") == "word", F.col("n"))).alias("words"),
        F.coalesce(F.sum(F.when(rest, F.col("n"))), F.lit(0)).alias("short"),
    )
    large = totals.where(F.col("words") >= rules.least_reference_words)
    # The k greatest counts of a language, in two steps: of its parts, then of those. Spark
    # keeps k rows of a group at a time for such a rank, so no group is gathered.
    pair = F.struct(F.col("n").alias("n"), F.col("item").alias("item"))
    best = [F.col("n").desc(), F.col("item").desc()]
    part = F.pmod(F.xxhash64("item"), F.lit(64))
    ranked = counts.where(rest).withColumn("part", part)
    for group in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*best))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= rules.common)
    tops = ranked.groupBy("lang").agg(
        F.reverse(F.array_sort(F.collect_list(pair))).alias("top")
    )
    classes = counts.where("kind = 'class'").groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("classes")
    )
    rows = large.join(classes, "lang").join(tops, "lang", "left").collect()
    found = {}
    for row in rows:
        top = row["top"] or []
        common = sum(n for n, _ in top)
        found[row["lang"]] = {
            "classes": [row["classes"].get(kind, 0) for kind in CLASSES],
            "words": [word for _, word in top],
            "counts": [n for n, _ in top]
            + [row["short"] - common, (row["words"] or 0) - row["short"]],
        }
    return found


def judged(documents: DataFrame, references: dict, rules: Rules = Rules()) -> DataFrame:
    """All rows and columns, with a struct ``quality`` (fields of ``RESULT``) added.

    It takes the place of any column of that name.
    """
    documents = without(documents, "quality", "_quality_lang")
    schema = T.StructType([*documents.schema.fields, T.StructField("quality", RESULT)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", class_table, short_word):
            langs = batch.column("_quality_lang").to_pylist()
            found = measured(texts_of(batch, "text"), langs, references, rules)
            arrays = [
                pa.array(found[field.name], from_pandas=True, type=kind)
                for field, kind in zip(RESULT.fields, ARROW)
            ]
            struct = pa.StructArray.from_arrays(arrays, names=RESULT.fieldNames())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, struct], names=schema.fieldNames())

    return ship(documents).withColumn("_quality_lang", language()).mapInArrow(judge, schema)


def good(documents: DataFrame, references: dict, rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with their columns as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", class_table, short_word):
            langs = batch.column(batch.num_columns - 1).to_pylist()
            found = measured(texts_of(batch, "text"), langs, references, rules)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            rows = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
            yield rows.filter(pa.array(found["kept"]))

    with_lang = ship(documents).select("*", language().alias("_quality_lang"))
    return with_lang.mapInArrow(keep, documents.schema)


ARROW = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]


def measured(texts: list[bytes], langs: list[str], references: dict, rules: Rules) -> dict:
    """Counts, distances and verdict of each text."""
    size = len(texts)
    codes, distinct, counts = coded_words(texts)
    classes = class_counts(texts)
    letters = np.array([len(word.decode("utf-8", "replace")) for word in distinct], dtype=np.int64)
    text = np.repeat(np.arange(size), counts)
    chars = np.bincount(text, weights=letters[codes], minlength=size) if len(codes) else np.zeros(size)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], dtype=np.int64)
    repeats = repeated_words(codes, counts)
    failed = (counts < 20) | (100 * repeats > 30 * counts)

    class_distance = np.full(size, np.nan)
    word_distance = np.full(size, np.nan)
    short = [short_word(word, rules.short) for word in distinct]
    used = np.array(langs, dtype=object)
    for lang in dict.fromkeys(used):
        reference = references.get(lang)
        if reference is None:
            continue
        rows = np.flatnonzero(used == lang)
        class_distance[rows] = divergence(classes[rows], np.array(reference["classes"], float))
        bins = {word: place for place, word in enumerate(reference["words"])}
        width = len(bins) + 2
        of = np.array(
            [width - 1 if word is None else bins.get(word, width - 2) for word in short], np.int64
        )
        local = np.full(size, -1)
        local[rows] = np.arange(len(rows))
        mine = local[text] >= 0
        cells = local[text[mine]] * width + (of[codes[mine]] if len(codes) else 0)
        table = np.bincount(cells, minlength=len(rows) * width).reshape(len(rows), width)
        word_distance[rows] = divergence(table, np.array(reference["counts"], float))
    class_distance[classes.sum(axis=1) < rules.least_chars] = np.nan
    word_distance[counts < rules.least_words] = np.nan
    with np.errstate(invalid="ignore"):
        odd = (class_distance > rules.most_class_distance) | (
            word_distance > rules.most_word_distance
        )
    return {
        "n_words": counts,
        "word_chars": chars.astype(np.int64),
        "n_symbols": symbols,
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "class_distance": class_distance,
        "word_distance": word_distance,
        "kept": ~failed & ~odd,
    }


def quality(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Documents with the struct ``quality``; references come from the same documents."""
    return judged(documents, language_references(documents, rules), rules)
