"""Golden 3: nearest centroid, Lloyd rounds, error sum, point and vector sources."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparrowmill.operators import cluster
from sparrowmill.sources import records, sinks
from sparrowmill.sources.text import read_lines

POINTS = [(0.0, 0.0), (0.0, 2.0), (10.0, 10.0), (10.0, 12.0), (30.0, 0.0)]
START = [(0, (0.0, 0.0)), (1, (10.0, 10.0)), (2, (100.0, 100.0))]
XY = ["x", "y"]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "x double, y double").withColumn("xy", F.array("x", "y")).persist()


@pytest.mark.parametrize("features", [XY, "xy"])
def test_assign(points, features):
    got = {(r.x, r.y): (r.cid, round(r.dist, 6)) for r in cluster.kmeans_assign(points, START, features).collect()}
    assert {p: cid for p, (cid, _) in got.items()} == dict(zip(POINTS, [0, 0, 1, 1, 1]))
    assert got[(0.0, 0.0)] == (0, 0.0) and got[(0.0, 2.0)] == (0, 2.0)


@pytest.mark.parametrize("features", [XY, "xy"])
def test_ties_and_close_centroids(points, features):
    tie = [(7, (0.0, 1.0)), (3, (0.0, 3.0)), (5, (0.0, 1.0))]
    assert {r.cid for r in cluster.kmeans_assign(points.where("x = 0 AND y = 2"), tie, features).collect()} == {3}
    close = [(0, (1.0, 22.0)), (1, (1.02, 2.0))]
    apart = points.sparkSession.createDataFrame([(1.0, 21.0), (1.0, 3.0)], "x double, y double")
    apart = apart.withColumn("xy", F.array("x", "y"))
    assert {r.cid for r in cluster.kmeans_step(apart, close, features).collect()} == {0, 1}


def test_step(points):
    got = {r.cid: (round(r.x, 6), round(r.y, 6)) for r in cluster.kmeans_step(points, START, XY).collect()}
    assert got == {0: (0.0, 1.0), 1: (16.666667, 7.333333)}
    arrays = {r.cid: [round(v, 6) for v in r.xy] for r in cluster.kmeans_step(points, START, "xy").collect()}
    assert arrays == {0: [0.0, 1.0], 1: [16.666667, 7.333333]}


@pytest.mark.parametrize("features", [XY, "xy"])
def test_wssse(points, features):
    once = cluster.kmeans_lloyd(points, features, iterations=1, init=START)
    assert round(cluster.wssse(points, once, features).first()[0], 6) == 351.333333


def test_lloyd_never_gets_worse(points):
    start = [(0, (0.0, 0.0)), (1, (10.0, 10.0)), (2, (20.0, 5.0))]
    errors = [
        cluster.wssse(points, cluster.kmeans_lloyd(points, XY, iterations=n, init=start), XY).first()[0]
        for n in range(4)
    ]
    assert errors == sorted(errors, reverse=True)


def test_lloyd_ignores_partitioning(points):
    one = cluster.kmeans_lloyd(points.coalesce(1), XY, iterations=3, init=START).collect()
    many = cluster.kmeans_lloyd(points.repartition(5), XY, iterations=3, init=START).collect()
    assert [[round(v, 9) for v in r] for r in one] == [[round(v, 9) for v in r] for r in many]


def test_random_start(points, spark):
    drawn = cluster.random_centroids(spark, 6, 2, seed=3)
    assert [cid for cid, _ in drawn] == list(range(6))
    assert all(cid - 3 <= v < cid - 2 for cid, coords in drawn for v in coords)
    assert drawn == cluster.random_centroids(spark, 6, 2, seed=3)
    assert 1 <= cluster.kmeans_lloyd(points, XY).count() <= 6


def test_columns_and_arrays_agree(spark):
    rows = [(0.1, 0.7), (5.3, 5.9), (4.4, 5.2), (0.0, 0.0), (100.0, 7.0)]
    points = spark.createDataFrame(rows, "x double, y double").withColumn("xy", F.array("x", "y"))
    for k in (3, 20, 400):  # generated code, batches of rows, a matrix product first
        start = [(i, (i * 0.37, i * 0.11)) for i in range(k)]
        by_columns = cluster.kmeans_assign(points, start, XY).orderBy("cid", "dist").collect()
        by_array = cluster.kmeans_assign(points, start, "xy").orderBy("cid", "dist").collect()
        assert [(r.cid, r.dist) for r in by_columns] == [(r.cid, r.dist) for r in by_array]
        means = {r.cid: repr([r.x, r.y]) for r in cluster.kmeans_step(points, start, XY).collect()}
        assert means == {r.cid: repr(r.xy) for r in cluster.kmeans_step(points, start, "xy").collect()}
    empty = points.limit(0)
    assert cluster.kmeans_step(empty, start, "xy").count() == 0
    assert cluster.kmeans_lloyd(empty, "xy", init=start).count() == 0


@pytest.mark.parametrize("k", [2, 400])
def test_points_without_a_coordinate(spark, k):
    nan, inf = float("nan"), float("inf")
    good, start = [(0.0, 0.0), (90.0, 10.0)], [(i, (i * 90.0, 0.0)) for i in range(k)]
    for bad in [(100.0, None), (nan, 1.0), (1.0, -inf)]:
        points = spark.createDataFrame([*good, bad], "x double, y double").withColumn("xy", F.array("x", "y"))
        for features in (XY, "xy"):
            for run in (cluster.kmeans_assign, cluster.kmeans_step, cluster.wssse):
                with pytest.raises(Exception, match="lacks one of its|coordinates"):
                    run(points, start, features).collect()
                assert run(points, start, features, "reject").count() in (1, 2)
            with pytest.raises(Exception, match="lacks one of its"):
                cluster.kmeans_lloyd(points, features, iterations=1, init=start)
            kept = cluster.kmeans_lloyd(points, features, iterations=1, init=start, on_bad="reject").orderBy("cid").collect()
            assert [list(r[1]) if features == "xy" else [r.x, r.y] for r in kept] == [[0.0, 0.0], [90.0, 10.0]]


def test_vectors_of_another_length(spark):
    points = spark.createDataFrame([([1.0],), ([2.0, 3.0, 4.0],), (None,), ([5.0, 6.0],)], "v array<double>")
    start = [(0, (0.0, 0.0)), (1, (9.0, 9.0))]
    for run in (cluster.kmeans_assign, cluster.kmeans_step):
        with pytest.raises(Exception, match="lacks one of its 2"):
            run(points, start, "v").collect()
    assert [r.v for r in cluster.kmeans_step(points, start, "v", "reject").collect()] == [[5.0, 6.0]]
    with pytest.raises(Exception, match="vectors of 2 numbers"):
        cluster._array_sums(points, start, "v").collect()


def test_many_centroids(spark, monkeypatch):
    """Screening and bounds find the same as comparing every point with every centroid, ties included."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 12, (1500, 3)), rng.normal(size=(500, 3)) + 1e6]).astype(float)
    points = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(3)
    start = [(i, tuple(c)) for i, c in enumerate(np.concatenate([x[:150], x[:20], x[1500:1540], [[-9e6] * 3]]).tolist())]
    searched = []
    got = cluster._bounded_rounds(points, "v", start, 7, searched)
    assert searched[0] == 2000 and sum(searched[4:]) < 0.6 * 3 * 2000
    monkeypatch.setattr(cluster, "SCREENED_FROM", 10**9)
    monkeypatch.setattr(cluster, "BOUNDED_FROM", 10**9)
    want = cluster.centroid_list(cluster.kmeans_lloyd(points, "v", iterations=7, init=start))
    assert [c for c, _ in got] == [c for c, _ in want] and len(got) < len(start)
    assert np.allclose([v for _, v in got], [v for _, v in want], rtol=1e-12, atol=1e-9)
    search = cluster._row_search([np.array(c) for _, c in start])
    monkeypatch.setattr(cluster, "SCREENED_FROM", 2)
    screened = cluster._row_search([np.array(c) for _, c in start])
    for a, b in zip(search(x)[:2], screened(x)[:2], strict=True):
        assert (a == b).all()


@pytest.mark.parametrize("features", [XY, "xy"])
def test_drawn_start(spark, features):
    rng = np.random.default_rng(6)
    rows = [(float(a), float(b)) for a, b in np.concatenate([rng.normal(size=(60, 2)) + c for c in (0, 100, 200, 300)])]
    points = spark.createDataFrame(rows * 2, "x double, y double").withColumn("xy", F.array("x", "y"))
    drawn = cluster.drawn_centroids(points, features, 4, seed=2)
    assert drawn == cluster.drawn_centroids(points.repartition(7), features, 4, seed=2)
    assert sorted(round(c[0], -2) for _, c in drawn) == [0, 100, 200, 300]
    assert {tuple(c) for _, c in drawn} <= set(rows)
    assert drawn != cluster.drawn_centroids(points, features, 4, seed=3)
    many = cluster.drawn_centroids(points, features, 100, seed=2)
    assert many == cluster.drawn_centroids(points.repartition(7), features, 100, seed=2)
    assert len({tuple(c) for _, c in many}) == 100
    assert len(cluster.drawn_centroids(points.limit(3), features, 5)) == 3
    assert cluster.drawn_centroids(points.limit(0), features, 5) == []
    ended = cluster.kmeans_lloyd(points.repartition(5), features, k=4, init="drawn", seed=2)
    assert cluster.wssse(points, ended, features).first()[0] < 2 * 240 * 2 * 2


def test_ml_finds_planted_clusters(spark):
    rng = np.random.default_rng(0)
    centers = [[0.0, 0.0, 0.0], [50.0, 0.0, 0.0], [0.0, 50.0, 50.0]]
    rows = [((c + rng.normal(size=3)).tolist(),) for c in np.array(centers) for _ in range(60)]
    vectors = spark.createDataFrame(rows, "v array<double>").select(array_to_vector("v").alias("features"))
    model, error = cluster.kmeans_ml(vectors, k=3, seed=5)
    found = sorted(model.clusterCenters(), key=lambda c: (round(c[0], -1), round(c[1], -1)))
    want = sorted(centers)
    assert all(np.abs(f - w).max() < 1 for f, w in zip(sorted(found, key=lambda c: (round(c[0] / 50), round(c[1] / 50))), want))
    assert 0 < error < 60 * 3 * 3 * 2
    again, same = cluster.kmeans_ml(vectors.repartition(7), k=3, seed=5)
    assert np.allclose(again.clusterCenters(), model.clusterCenters(), atol=1e-9) and abs(same - error) < 1e-6
    centers = [(i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
    arrays = spark.createDataFrame(rows, "v array<double>")
    assert abs(cluster.wssse(arrays, centers, "v").first()[0] - error) < 1e-6


def test_point_lines(spark):
    lines = spark.createDataFrame([("1.5, 2,9",), ("3,4",), ("5",), ("a,b",), ("6,7,,",)], "value string")
    assert {tuple(r) for r in records.read_points(lines, on_bad="reject").collect()} == {(1.5, 2.0), (3.0, 4.0), (6.0, 7.0)}
    assert {r.value for r in records.point_rejects(lines).collect()} == {"5", "a,b"}
    with pytest.raises(Exception, match="bad point"):
        records.read_points(lines).collect()
    with pytest.raises(ValueError):
        records.read_points(lines, on_bad="skip")


def test_vector_lines(spark):
    lines = spark.createDataFrame([("1,2,3",), ("4,5,6",)], "value string")
    got = [r.features.toArray().tolist() for r in records.read_vectors(lines).collect()]
    assert sorted(got) == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    with pytest.raises(Exception, match="bad vector"):
        records.read_vectors(spark.createDataFrame([("1,x",)], "value string")).collect()


def test_centroids_saved_and_read(points, spark, tmp_path):
    path = str(tmp_path / "centroids")
    step = cluster.kmeans_step(points, START, XY).orderBy("cid").coalesce(1)
    sinks.write_kv(step, path, "x", "y")
    saved = records.read_centroids(read_lines(spark, path))
    assert [(r.cid, round(r.x, 6), round(r.y, 6)) for r in saved.orderBy("cid").collect()] == [
        (0, 0.0, 1.0), (1, 16.666667, 7.333333),
    ]
    assert {r.cid for r in cluster.kmeans_assign(points, saved, XY).collect()} == {0, 1}
