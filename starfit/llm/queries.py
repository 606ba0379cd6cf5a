"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfit.llm import (
    byte_bpe,
    chat_format,
    lexical,
    ngram_join,
    packing,
    quality_model,
    quality_rules,
    repair,
    sharding,
    suffix_dedup,
    toxicity,
    vector_dedup,
    warc,
)
from starfit.llm.oracle_sql import ORACLE_SQL
from starfit.llm.tables import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staged(quality_model.document_statistics(_table(spark, sf_dir, "documents")), "statistics")
    return quality_model.score(vectors, quality_model.train(vectors, _table(spark, sf_dir, "labels")))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.compression_bands(_table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def packed(docs: DataFrame) -> DataFrame:
    """Documents packed with the public 50k byte-level vocabulary."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return packing.pack_documents(docs, file.read(), public_tokenizers.PATTERN)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return warc.read_archives(warc.write_archives(pages, warc.archive_folder(pages)))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.encode_documents(_table(spark, sf_dir, "documents"), vocabulary)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(planted)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_quality_classifier,
        op3_embedding_near_dedup,
        op4_sharding,
        op5_quality_rules,
        op6_suffix_array_dedup,
        op7_best_fit_packing,
        op8_warc,
        op9_byte_bpe,
        op10_ngram_jaccard_join,
        op11_lexical_search,
        op12_chat_format,
        op13_conversation_repair,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES", "packed"]
