"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quincena.llm import exact, minhash, packing, substrings, toxicity
from quincena.llm.common import documents
from quincena.llm.queries import JSON, labels
from quincena.session import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model, learnt from the labels, does not reject."""
    return toxicity.keep_clean(docs, toxicity.train(docs, labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, rows without an id included."""
    return minhash.keep_one_row(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat; documents of which nothing is left go."""
    # Only id and text go by their names, so that no column of the caller's meets one of the results.
    plain = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    left = substrings.remove_repeats(docs.toDF(*plain.values())).filter("n_removed = 0 OR n_removed < n_words")
    text = F.col("kept_text")
    return left.select(*[text.alias(c) if c == "text" else
                         F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col(p)).alias(c)
                         if c == "n_chars" else F.col(p).alias(c) for c, p in plain.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place in it."""
    return packing.pack_documents(docs, public_tokenizers.path(JSON))


STAGES = [("toxicity", reject_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("substring dedup", drop_passages), ("packing", pack)]

# Tokens, random hashes and a fitted model are beyond SQL: tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
