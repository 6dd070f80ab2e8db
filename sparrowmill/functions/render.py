"""Text forms of pairs, postings and index keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def pair_text(left: Column | str, right: Column | str) -> Column:
    """``(left,right)``"""
    return F.concat(F.lit("("), _text(left), F.lit(","), _text(right), F.lit(")"))


def postings_text(postings: Column | str) -> Column:
    """``(doc,tf)(doc,tf)...`` without a separator."""
    return F.array_join(F.transform(postings, lambda p: pair_text(p["doc"], p["tf"])), "")


def index_key(term: Column | str, df: Column | str) -> Column:
    """``term df``"""
    return F.concat_ws(" ", _text(term), _text(df))
