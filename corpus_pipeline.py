"""A corpus pipeline of five stages, from raw documents to token digests.

Toxic documents go, then documents that the quality rules reject, then near copies; the
rest is mixed to target weights and encoded. Each stage is written as Parquet in the folder
that executors share and read again by the next. Null texts are empty, and so fail the
quality rules; null ids are ids like others; rows that repeat id and text are copies, of
which one stays; extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventflat.llm import bpe, mixing, near_dup, quality_divergence, toxicity_kn
from eventflat.llm.common import stored
from eventflat.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity_kn.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_kn.ordinary(docs, model)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, by references made of the documents given."""
    return quality_divergence.good(docs, quality_divergence.language_references(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    return near_dup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text."""
    found = bpe.encode_decode(docs.select("doc_id", "text"), tokenizer_path())
    return found.select("doc_id", "bpe.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Model scores, sketches and byte-pair merges are no SQL: tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
