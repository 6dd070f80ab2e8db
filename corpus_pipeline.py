"""Cleaning a corpus: classifier, rules, near duplicates, shared passages, packing.

Each stage takes what the one before kept, as a written table. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparrowmill.llm import bands, classifier, fmindex, jaccard, packing
from sparrowmill.session import drop_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    model = classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.accepted_documents(docs, model)


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return bands.kept_documents(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def without_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, the words of repeated passages cut out of their texts."""
    return fmindex.kept_texts(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classified),
    ("quality rules", by_rules),
    ("n-gram Jaccard join", without_near_duplicates),
    ("substring dedup", without_shared_passages),
    ("packing", packed),
]

# A trained classifier, compression ratios and a tokenizer are beyond SQL; a test runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``.

    What each stage returns is stored and read again; it is deleted once the
    next stage is stored, and that of the last but one when the application ends.
    """
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for place, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if place == len(STAGES) - 1:
            return out
        path = scratch_path(spark, "stage")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if held is not None:
            drop_path(spark, held)
        held = path
    return docs
