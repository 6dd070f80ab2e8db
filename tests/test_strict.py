"""Strict parsing, long blanks, and points without a number."""

import time

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import cluster, graph
from sparrowmill.sources import records


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    ("read", "good", "bad"),
    [
        (records.read_edges, "a b", "a"), (records.read_points, "1,2", "1,x"), (records.read_vector_arrays, "1,2", "1,x"),
        (records.read_counts, "a 1", "a x"), (records.read_centroids, "1 2", "1 x"),
    ],
)
def test_strict_parsing_survives_pruning(spark, read, good, bad):
    assert read(lines(spark, good, good)).count() == 2
    rows = read(lines(spark, good, bad))
    for use in (rows.count, rows.select(rows.columns[0]).collect, rows.select(F.lit(1)).collect):
        with pytest.raises(Exception, match="needs two fields|bad "):
            use()


def test_long_blanks(spark):
    long = lines(spark, "a b" + " " * 100_000 + "c" + " " * 100_000, "1,2" + "," * 100_000)
    began = time.perf_counter()
    assert records.read_edges(long.limit(1)).collect()[0].dst == "b"
    assert records.read_points(long.where("value like '1,%'")).collect()[0].y == 2.0
    assert time.perf_counter() - began < 20


def test_fields_before_a_line_separator(spark):
    assert records.point_rejects(lines(spark, "1,2,,\u2028")).count() == 0
    assert records.read_vector_arrays(lines(spark, "1,2,,\u2028"), "reject").count() == 0


def test_points_without_numbers(spark):
    rows = [(1.0, 2.0), (None, 2.0), (float("nan"), 2.0)]
    points = spark.createDataFrame(rows, "x double, y double")
    vectors = spark.createDataFrame([([x, y],) for x, y in rows] + [(None,)], "v array<double>")
    centroids = [(3, (0.0, 0.0)), (5, (1.0, 2.0))]
    for df, features in ((points, ["x", "y"]), (vectors, "v")):
        with pytest.raises(Exception, match="a point lacks one of its 2 coordinates"):
            cluster.kmeans_assign(df, centroids, features).collect()
        kept = cluster.kmeans_assign(df, centroids, features, on_bad="reject").collect()
        assert [(r.cid, r.dist) for r in kept] == [(5, 0.0)]
        assert df.where(cluster.point_ok(features)).count() == 1


def test_no_points(spark):
    points = spark.createDataFrame([], "x double, y double")
    assert cluster.kmeans_lloyd(points, ["x", "y"], init=[(0, (0.0, 0.0))]).count() == 0


def test_ranks_of_all_pages(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "a")], "src string, dst string")
    ranks = {r.page: round(r.rank, 6) for r in graph.pagerank(edges, 2, output="all").collect()}
    assert set(ranks) == {"a", "b", "c", "d"} and ranks["d"] == 0.15
