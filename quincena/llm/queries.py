"""Registered queries: each operator over its whole table, with its production
parameters, as the columns that its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quincena.llm import (bpe, codes, counts, exact, imatch, lines, minhash, neighbours, packing, substrings, toxicity,
                          trie, urls)
from quincena.llm.common import documents

JSON = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Verdict and host/path of each rule.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(JSON))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return imatch.edited(docs, imatch.lexicon(docs))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(JSON))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.resolve(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir))).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_url_filter, op3_bpe, op4_substring_dedup, op5_line_dedup,
                                   op6_minhash, op7_imatch, op8_token_counts, op9_exact_dedup, op10_toxicity,
                                   op11_collision_search, op12_vector_codes, op13_prefix_trie)}
