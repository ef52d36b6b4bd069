"""From raw documents to packed training sequences, each stage one operator of ``marginloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows that the stage before it
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginloom.llm.exact_dedup import drop_exact_copies
from marginloom.llm.mil_classifier import keep_classified
from marginloom.llm.packing import pack, token_pieces
from marginloom.llm.quality_rules import keep_quality, trusted_ids
from marginloom.llm.scratch import Scratch
from marginloom.llm.simhash import drop_near_copies


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like the trusted ones."""
    return keep_quality(docs, trusted_ids(_labels(spark, sf_dir)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model doesn't reject. It learns from the labelled ones of the whole input: the
    rules before this stage leave hardly any negative example."""
    every = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return keep_classified(docs, _labels(spark, sf_dir), learn_from=every)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest doc_id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest doc_id."""
    return drop_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences."""
    return pack(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("best_fit_packing", packing),
]

#: A trained model and tokens are no matter for SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
