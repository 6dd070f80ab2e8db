"""Edges, points, vectors, counts and centroids parsed from text lines.

Every parser takes a DataFrame with a ``value`` column, as ``read_lines``
gives. With ``on_bad="fail"`` a malformed line stops the job; with
``"reject"`` it is left out here and returned by the matching ``*_rejects``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector

from ..functions.parse import as_double, check_on_bad, comma_fields, require
from ..functions.text import WHITESPACE_ONE, WHITESPACE_RUN, trimmed_fields


def _split(lines: DataFrame, fields: Column) -> DataFrame:
    return lines.select("value", fields.alias("fields"))


def _keep(parsed: DataFrame, ok: Column, columns: dict[str, Column], on_bad: str, what: str) -> DataFrame:
    check_on_bad(on_bad)
    kept = parsed.where(ok if on_bad == "reject" else require(ok, "value", what))
    return kept.select(*[c.alias(n) for n, c in columns.items()])


# -- edges ------------------------------------------------------------------

def _edge_fields(lines: DataFrame, single_space: bool) -> DataFrame:
    return _split(lines, trimmed_fields("value", WHITESPACE_ONE if single_space else WHITESPACE_RUN))


def read_edges(lines: DataFrame, on_bad: str = "fail", single_space: bool = False) -> DataFrame:
    """``(src, dst)`` from the first two fields of each line.

    Fields are parted by runs of whitespace, or with ``single_space`` by each
    whitespace character, so that two spaces enclose an empty field.
    """
    columns = {"src": F.get("fields", F.lit(0)), "dst": F.get("fields", F.lit(1))}
    return _keep(_edge_fields(lines, single_space), F.size("fields") >= 2, columns, on_bad, "edge needs two fields")


def edge_rejects(lines: DataFrame, single_space: bool = False) -> DataFrame:
    return _edge_fields(lines, single_space).where(F.size("fields") < 2).select("value")


# -- points and vectors -----------------------------------------------------


def _numbers(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.transform(comma_fields("value"), as_double).alias("fields"))


def _point_ok(dims: int) -> Column:
    return (F.size("fields") >= dims) & ~F.exists(F.slice("fields", 1, dims), lambda v: v.isNull())


def read_points(lines: DataFrame, names: tuple[str, ...] = ("x", "y"), on_bad: str = "fail") -> DataFrame:
    """Leading comma-separated numbers as columns; further fields are ignored."""
    columns = {name: F.get("fields", F.lit(i)) for i, name in enumerate(names)}
    return _keep(_numbers(lines), _point_ok(len(names)), columns, on_bad, "bad point")


def point_rejects(lines: DataFrame, dims: int = 2) -> DataFrame:
    return _numbers(lines).where(~_point_ok(dims)).select("value")


def _vector_ok() -> Column:
    return ~F.exists("fields", lambda v: v.isNull())


def read_vector_arrays(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """All comma-separated numbers of each line as ``features ARRAY<DOUBLE>``."""
    return _keep(_numbers(lines), _vector_ok(), {"features": F.col("fields")}, on_bad, "bad vector")


def read_vectors(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """All comma-separated numbers of each line as an ML vector column ``features``."""
    return read_vector_arrays(lines, on_bad).select(array_to_vector("features").alias("features"))


# -- side tables ------------------------------------------------------------

def _count_fields(lines: DataFrame) -> DataFrame:
    return _split(lines, trimmed_fields("value", WHITESPACE_RUN))


def read_counts(lines: DataFrame) -> DataFrame:
    """``(term, n)`` from rows of exactly two fields; a count that is no number fails."""
    n = F.get("fields", F.lit(1)).try_cast("bigint")
    return (
        _count_fields(lines)
        .where(F.size("fields") == 2)
        .where(require(n.isNotNull(), "value", "bad count"))
        .select(F.get("fields", F.lit(0)).alias("term"), n.alias("n"))
    )


def count_rejects(lines: DataFrame) -> DataFrame:
    """Side-table rows that do not have exactly two fields."""
    return _count_fields(lines).where(F.size("fields") != 2).select("value")


def read_centroids(lines: DataFrame) -> DataFrame:
    """``(cid, x, y)`` from saved ``x TAB y`` rows, numbered in order of the coordinates."""
    parsed = lines.select(
        "value",
        F.transform(trimmed_fields("value", WHITESPACE_RUN), as_double).alias("fields"),
    )
    found = parsed.where(require(_point_ok(2), "value", "bad centroid")).select(
        *[F.get("fields", F.lit(i)).alias(n) for i, n in enumerate("xy")]
    )
    # k rows; the number does not depend on how they lie in files.
    return found.select((F.row_number().over(Window.orderBy("x", "y")) - 1).cast("bigint").alias("cid"), "x", "y")
