"""From raw documents to token ids: five stages, each on all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roost.llm import bpe, jaccard, mixing, pii, toxicity
from roost.sources.stage import new_path


def no_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go. It learns from the labels of what is there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    params = toxicity.ToxicityParams()
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels, toxicity.CATEGORIES, params), params)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by shingles, directly or through others, the one of smallest id stays."""
    return jaccard.one_of_each(docs)


def no_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to the name of its kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources of equal weight, counted in characters: documents repeat or go as drawn."""
    return mixing.mix(docs, mixing.MixParams(size="coalesce(n_chars, length(text))"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every whole text as ids, and as the text that those ids decode to."""
    return bpe.tokenize_documents(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


STAGES = [
    ("toxicity", no_toxic),
    ("jaccard", no_near_copies),
    ("pii", no_pii),
    ("mixing", mixed),
    ("bpe", tokens),
]

# The classifier is not expressible in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
