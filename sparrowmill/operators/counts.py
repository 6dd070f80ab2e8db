"""Word counts, document frequencies and term frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_terms, tokenize, tokenize_ws


def tokenized(corpus: DataFrame, tokens: Column | None = None) -> DataFrame:
    """``(doc, line_no, tokens)``"""
    return corpus.select("doc", "line_no", (tokenize("line") if tokens is None else tokens).alias("tokens"))


def exploded(records: DataFrame, terms: Column, *keep: Column | str) -> DataFrame:
    """``(keep..., pos, term)``: one row per element of ``terms``.

    The outer form with a filter behind it, since before an inner explode the
    optimizer adds a test for empty arrays that evaluates ``terms`` once more.
    """
    return records.select(*keep, F.posexplode_outer(terms).alias("pos", "term")).where("term IS NOT NULL")


def word_count(records: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences of each term."""
    return exploded(records, F.col("tokens")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def doc_frequency(records: DataFrame) -> DataFrame:
    """``(term, df)``: records containing each term."""
    return (
        exploded(records, distinct_terms("tokens"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def term_frequency(corpus: DataFrame, granularity: str = "document", keep_empty: bool = False) -> DataFrame:
    """``(doc, term, tf)``, or ``(doc, line_no, term, tf)`` for ``granularity="record"``."""
    unit = {"document": ["doc"], "record": ["doc", "line_no"]}[granularity]
    if granularity == "record":
        # Lines travel, not their terms, which are then counted where they lie.
        corpus = corpus.repartition(*unit)
    return (
        exploded(corpus, tokenize_ws("line", keep_empty), *unit)
        .groupBy(*unit, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
