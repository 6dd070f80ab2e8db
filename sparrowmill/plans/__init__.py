"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cluster, graph, text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {**text.QUERIES, **graph.QUERIES, **cluster.QUERIES}
SQL: dict[str, str] = {**text.SQL, **graph.SQL, **cluster.SQL}
