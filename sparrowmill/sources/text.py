"""Line-oriented corpora from text files and from table columns.

A corpus is a DataFrame ``(doc, line_no, line)``. ``(doc, line_no)`` names a
record: one line of text, the unit in which terms co-occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_lines
from ..session import listed_by

# Listing a document's folder takes far less than a task does.
LISTING_TASKS_PER_CORE = 2


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file_name)`` for every line of a file or directory."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Text files as a corpus; the file name is the document.

    ``line_no`` is unique and increasing within a file, not a dense count. It
    is taken at the scan, where a retried task sees the same rows in the same
    order.
    """
    return read_lines(spark, path).select(
        F.col("file_name").alias("doc"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The corpus that ``write_documents`` wrote: a document is known by its folder's name, however it looks.

    ``line_no`` is as in ``read_corpus``.
    """
    with listed_by(spark, LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism):
        named = spark.read.schema("value string, document string").text(path)
    return named.select(
        F.col("document").alias("doc"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def corpus_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A table column as a corpus: one row per line of each text.

    ``id_col`` must be unique in ``df``.
    """
    # An inner explode makes the optimizer test the array for emptiness first,
    # splitting every text twice; the outer form splits once.
    return df.select(
        F.col(id_col).cast("string").alias("doc"),
        F.posexplode_outer(split_lines(text_col)).alias("line_no", "line"),
    ).where("line IS NOT NULL")


def read_table(spark: SparkSession, path: str, columns: list[str], spread_by: str | None = None) -> DataFrame:
    """Parquet columns, spread over the cores where the scan alone would not.

    A large table already splits into more scan tasks than there are cores and
    is left as it lies. A table of few splits is hashed on ``spread_by``, so
    that the costly work on each row does not run in a task or two.
    """
    df = spark.read.parquet(path).select(*columns)
    if spread_by is not None:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < 2 * cores:
            df = df.repartition(cores, spread_by)
    return df
