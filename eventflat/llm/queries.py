"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversation_trie,
    cover_tree,
    mixing,
    near_dup,
    periodic_runs,
    piece_table,
    quality_divergence,
    sharding,
    token_frames,
    toxicity_kn,
    url_graph,
    warc,
)
from .oracle import ORACLE

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_divergence.quality(documents).select("doc_id", "quality.*")


def op2_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_kn.fitted(documents, table(spark, sf_dir, "labels"))
    return toxicity_kn.scored(documents, model).select(
        "doc_id",
        toxicity_kn.held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dup.near_duplicates(documents, near_dup.Settings(words=4))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_frames.frames(documents, tokenizer_path())
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(documents, tokenizer_path()).select("doc_id", "bpe.*")


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judged(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.run_digests(periodic_runs.with_planted_tails(documents))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.with_planted_heads(own))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_table.digests(documents, tokenizer_path(PIECES)).select("doc_id", "pieces.*")


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_divergence,
        op2_toxicity_kneser_ney,
        op3_source_mixing,
        op4_near_duplicates,
        op5_hash_tree_shards,
        op6_token_frames,
        op7_warc,
        op8_bpe,
        op9_embedding_near_duplicates,
        op10_url_graph,
        op11_periodic_runs,
        op12_conversation_trie,
        op13_sentencepiece,
    )
}

__all__ = ["ORACLE", "QUERIES"]
