"""Corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

toxicity and join and decontamination drop documents, pii redacts texts, packing
returns the training sequences. A stage takes (spark, docs, sf_dir); all but the
last return the columns of ``documents``. Stages with Python workers hold the session's Arrow
batches at 1,000 rows, so that a worker and its executor hold few texts at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import decontamination, ngram_join, packing, pii, toxicity
from shoplens.llm.common import small_batches, stored

#: No SQL can express the learned stages; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lexicon is learned from the labelled documents of the corpus; documents scoring 0.3 or more go."""
    small_batches(spark)
    return toxicity.reject(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (word 5-grams, Jaccard 0.8 or more) stays."""
    small_batches(spark)
    return ngram_join.keep_one(docs, threshold=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    small_batches(spark)
    return decontamination.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a placeholder in the text."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 2,048 tokens."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("pii", redact_personal_data), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
