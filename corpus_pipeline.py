"""A corpus from raw documents to packed bins: toxicity, near duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs. All but the
last return the columns of `documents`. Rejected are toxic documents and all but one of each group of near duplicates; every other
document goes through. Secrets are cut out of the texts, the mix is the order of the rows, the last stage returns the bins, packed along that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.llm import jaccard, mixing, packing, secrets, toxicity
from quizlens.sinks.stage import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from `labels`, from the training fold only.

    A model that found no words to judge by rejects nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    if not model.weights:
        return docs
    return toxicity.score(docs, model, keep=True).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    return jaccard.one_of_each(docs)


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order: range partitions of slots, each sorted."""
    mixed = mixing.mix(docs, F.length("text"))
    return mixing.in_order(mixed).select(*docs.columns)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in bins of 2048 words: a row per piece; numbers of bins follow the mixed order stretch by stretch."""
    return packing.pack(docs, packing.word_count(docs["text"]), packing.copies(docs["text"]), order=packing.read_order(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("secrets", cut_secrets),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

# the classifier, the compressor and best fit have no SQL form; tests/llm compare the pipeline with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
