"""Inverted index with document frequency and sorted postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.render import index_key, pair_text, postings_text
from ..functions.text import distinct_terms, tokenize_ws
from .counts import exploded, term_frequency
from .lists import LIST_SIZE, bounded_lists
from .ranges import index_lists


def postings(corpus: DataFrame, granularity: str = "document", keep_empty: bool = False) -> DataFrame:
    """``(term, doc, tf)``: a posting of a document, or with ``granularity="record"`` of each line, to a row."""
    return term_frequency(corpus, granularity, keep_empty).select("term", "doc", "tf")


def inverted_index(
    corpus: DataFrame,
    granularity: str = "document",
    keep_empty: bool = False,
    order: str = "struct",
    size: int = LIST_SIZE,
) -> DataFrame:
    """``(term, df, segment, postings ARRAY<STRUCT<doc, tf>>)``.

    ``df`` is the number of postings of the term. Postings are sorted by
    document and count, or with ``order="text"`` by their rendered form, which
    puts ``(a,10)`` before ``(a,2)``. A term with more than ``size`` postings
    has several segments, to be read in order.
    """
    if order not in ("struct", "text"):
        raise ValueError(f"order must be 'struct' or 'text', not {order!r}")
    if granularity not in ("document", "record"):
        raise ValueError(f"granularity must be 'document' or 'record', not {granularity!r}")
    if _documents_in_order(corpus, order):
        # Rendered, a document's name ends with a comma.
        by = F.concat("doc", F.lit(",")) if order == "text" else "doc"
        tokens = tokenize_ws("line", keep_empty)
        lists = index_lists(corpus, tokens, by, granularity == "record", order == "text", size)
        return lists.select(
            F.col("key").alias("term"), F.col("total").alias("df"), "segment", F.col("items").alias("postings")
        )
    rows, by = postings(corpus, granularity, keep_empty), ["doc", "tf"]
    if order == "text":
        rows, by = rows.withColumn("text", pair_text("doc", "tf")), ["text"]
    # A term has no more postings than lines that hold it, which are counted without a shuffle of its documents.
    lines = exploded(corpus, distinct_terms(tokenize_ws("line", keep_empty)))
    most = lines.groupBy("term").agg(F.count(F.lit(1)).alias("most"))
    n_lines = corpus.count()
    return bounded_lists(rows, "term", by, ["doc", "tf"], None, size, most, n_lines).select(
        "term", F.col("total").alias("df"), "segment", F.col("items").alias("postings")
    )


def _documents_in_order(corpus: DataFrame, order: str) -> bool:
    """Whether all postings of one document come before all of another.

    In rendered form ``a`` with its count may lie between two postings of ``a,5``.
    """
    if corpus.schema["doc"].dataType != T.StringType():
        return False
    return order == "struct" or corpus.where(F.contains("doc", F.lit(","))).isEmpty()


def render_index(index: DataFrame) -> DataFrame:
    """``(key, segment, value)``: ``term df`` and ``(doc,tf)(doc,tf)...``."""
    return index.select(
        index_key("term", "df").alias("key"), "segment", postings_text("postings").alias("value")
    )
