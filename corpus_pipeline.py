"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

``run(spark, sf_dir)`` writes every stage's result to the shared scratch folder and reads it back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rondo.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from rondo.llm.store import share_code, small_batches, stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    share_code(spark)
    small_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the document with the smallest id stays."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by 0.8 or more of their shingles of five words."""
    share_code(spark)
    small_batches(spark)
    return ngram_join.drop_near_copies(docs, shingle=5, num=80, den=100)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights, and half of the tokens stay."""
    return mixing.mix(docs, mixing.TARGETS, mixing.columns_of(), keep=0.5)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of 4096 tokens."""
    share_code(spark)
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

#: A trained classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
