"""Text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.render import pair_text


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def write_kv(df: DataFrame, path: str, key: Column | str, value: Column | str, mode: str = "error") -> None:
    """One ``key TAB value`` line per row; ``mode="overwrite"`` replaces old output."""
    df.select(F.concat_ws("\t", _text(key), _text(value)).alias("value")).write.mode(mode).text(path)


def write_tuples(df: DataFrame, path: str, key: Column | str, value: Column | str, mode: str = "error") -> None:
    """One ``(key,value)`` line per row."""
    df.select(pair_text(key, value).alias("value")).write.mode(mode).text(path)


def write_documents(corpus: DataFrame, path: str, mode: str = "error") -> None:
    """Each document of a corpus as a text file of its lines in order, in a folder ``document=<name>``.

    A document is written by one task; a task writes its documents one by one.
    """
    rows = corpus.select(F.col("doc").alias("document"), "line_no", F.col("line").alias("value"))
    (
        rows.repartition("document").sortWithinPartitions("document", "line_no").select("document", "value")
        .write.mode(mode).partitionBy("document").text(path)
    )
