"""The queries of this package by name, each over its whole table, and their SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import bpe, chat, checks, chunks, mixing, negatives, pii, pq, quartiles, repetition, simhash, tokens, tries, urls
from tallybook.llm.common import table
from tallybook.staging import Stage


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judge(table(spark, folder, "documents", "doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, folder, "documents", "doc_id", "text"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages", "page_id", "url"))


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return chat.format_chat(turns, chat.train(turns))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(table(spark, folder, "documents", "doc_id", "text"), path, derive=bpe.digests())


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """From an empty cache of its own, so that every content is encoded."""
    stage = Stage(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents", "doc_id", "text")
    return tokens.count_tokens(docs, path, f"{stage.root}/token-counts", stage=stage)


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, folder, "documents", "doc_id", "text")))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents", "doc_id", "source", "text"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pq.near_vectors(table(spark, folder, "embeddings", "vec_id", "embedding"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return quartiles.edited(table(spark, folder, "documents", "doc_id", "text"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.rebuilt_trie(table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_substring_dedup, op3_url_filter, op4_chat, op5_bpe, op6_simhash, op7_token_counts, op8_pii,
    op9_mixing, op10_embedding_dedup, op11_hard_negatives, op12_fingerprints, op13_conversation_trie)} | {"pipeline": corpus_pipeline.run}
ORACLE = checks.sql_by_query()
