"""From raw documents to packed training sequences, as five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its
result is written as Parquet and read again as the next one's documents.  All stages but the
last return the columns of ``documents``.

``ORACLE_SQL`` is None: language identification, fingerprints and packing cannot be stated in
SQL.  ``tests/llm/test_pipeline.py`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.scratch import written
from tidemark.llm import contamination, exact, language, packing, simhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the rejected ones go."""
    return language.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact.drop_exact_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near fingerprints bring texts together; of each component with a five-word Jaccard similarity of 0.8 or more the smallest id stays."""
    return simhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
