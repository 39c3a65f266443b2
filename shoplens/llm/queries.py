"""Registered queries of the text-corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (decontamination, language_id, lm_scoring, mixing, neighbours, ngram_join, packing, pii, quality,
                          resampling, sharding, spelling, toxicity)
from shoplens.llm.oracle import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


@_query
def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


@_query
def op3_decontamination(spark, sf_dir):
    found = decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query
def op4_sharding(spark, sf_dir):
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))


@_query
def op5_pii(spark, sf_dir):
    return pii.detect(_table(spark, sf_dir, "documents"))


@_query
def op6_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


@_query
def op7_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op8_neighbours(spark, sf_dir):
    return neighbours.search(_table(spark, sf_dir, "embeddings"))


@_query
def op9_ngram_join(spark, sf_dir):
    return ngram_join.join(_table(spark, sf_dir, "documents"))


@_query
def op10_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


@_query
def op11_mixing(spark, sf_dir):
    found = mixing.repetitions(_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("kept.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query
def op12_resampling(spark, sf_dir):
    found = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op13_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))
