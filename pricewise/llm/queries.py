"""Registered queries of the operators: each applies its operator, with production
parameters, to its whole table, and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.llm import (
    chat, embeddings, langid, licenses, mixing, negatives, pieces, quality, resample, sharding, token_counts, warc)
from pricewise.llm.common import ship, table
from pricewise.llm.jaccard import jaccard_components


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as
    read back from the archives written."""
    read = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, lang (null: rejected), probability, declared, host for every page; the
    text model learns from labelled documents."""
    return langid.identify_pages(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, canonical_digest, license_id, notices for every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known(spark))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, lossless for every document."""
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.tokenize(table(spark, sf_dir, "documents"), model)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed, posterior, kept for every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    vocabulary = token_counts.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every
    conversation, and of -7, whose texts hold control strings; read back from the ids."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    vocabulary = chat.ChatVocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return chat.read_back(chat.format_chat(rows.unionByName(planted), vocabulary), vocabulary, in_order=True) \
        .withColumnRenamed("conv", "conv_id")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every document, drawn
    towards the texts of ``benchmark``."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Labels of
    rows whose id is divisible by 7 are shifted; anchors are those divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_warc, op2_sharding, op3_language_id, op4_jaccard_join, op5_license_scan, op6_embedding_dedup, op7_sentencepiece,
        op8_quality_rules, op9_token_counts, op10_source_mix, op11_chat_format, op12_resample, op13_hard_negatives)
}

#: The other operators are compared with brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": warc.ORACLE_SQL,
    "op5_license_scan": licenses.oracle_sql(),
    "op10_source_mix": mixing.ORACLE_SQL,
    "op11_chat_format": chat.ORACLE_SQL,
    "op12_resample": resample.ORACLE_SQL,
    "op13_hard_negatives": negatives.ORACLE_SQL,
}
