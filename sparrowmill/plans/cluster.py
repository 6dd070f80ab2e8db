"""k-means over ``lineitem`` (two numbers a point) and ``embeddings`` (arrays)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster
from ..session import cut_lineage, scratch
from ..sources import records, sinks
from ..sources.text import read_lines, read_table

XY = ["x", "y"]
K = 6
ROUNDS = 10
SEED = 1
START = [(i, (10.0 * i, 10000.0 * i)) for i in range(1, K + 1)]


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_quantity", "l_extendedprice"])
    return table.select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/embeddings.parquet", ["vec_id", "embedding"], "vec_id")


def first_embeddings(spark: SparkSession, sf_dir: str) -> list[tuple[int, list[float]]]:
    """The starting centroids: the vectors of the lowest ids."""
    rows = embeddings(spark, sf_dir).orderBy("vec_id").limit(K).collect()
    return [(i, row["embedding"]) for i, row in enumerate(rows)]


def _dims(centroids: DataFrame) -> DataFrame:
    return centroids.select("cid", F.posexplode("embedding").alias("dim", "value")).select(
        "cid", "dim", F.round("value", 6).alias("value")
    )


def _xy(centroids: DataFrame) -> DataFrame:
    return centroids.select(F.col("cid").cast("int").alias("cid"), *[F.round(c, 4).alias(c) for c in XY])


def _point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated lines of three fields; some hold no second number."""
    table = read_table(
        spark, f"{sf_dir}/lineitem.parquet", ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    )
    second = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    return table.select(F.concat_ws(",", "l_quantity", second, "l_discount").alias("value"))


def points_from_csv(spark, sf_dir):
    return records.read_points(_point_lines(spark, sf_dir), on_bad="reject")


def point_rejects(spark, sf_dir):
    return records.point_rejects(_point_lines(spark, sf_dir)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.transform("embedding", lambda v: v.cast("double").cast("string"))
    return embeddings(spark, sf_dir).select(F.array_join(numbers, ",").alias("value"))


def vectors_from_csv(spark, sf_dir):
    return (
        records.read_vector_arrays(_vector_lines(spark, sf_dir))
        .select(F.posexplode("features").alias("dim", "value"))
        .groupBy("dim")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )


def kmeans_assign(spark, sf_dir):
    assigned = cluster.kmeans_assign(embeddings(spark, sf_dir), first_embeddings(spark, sf_dir), "embedding")
    return assigned.select("vec_id", "cid", F.round("dist", 6).alias("dist"))


def kmeans_assign_points(spark, sf_dir):
    assigned = cluster.kmeans_assign(points(spark, sf_dir), START, XY)
    return assigned.select(*XY, "cid", F.round("dist", 4).alias("dist"))


def kmeans_step(spark, sf_dir):
    return _dims(cluster.kmeans_step(embeddings(spark, sf_dir), first_embeddings(spark, sf_dir), "embedding"))


def kmeans_lloyd(spark, sf_dir):
    return _xy(cluster.kmeans_lloyd(points(spark, sf_dir), XY, iterations=ROUNDS, init=START))


def kmeans_lloyd_embeddings(spark, sf_dir):
    return _dims(
        cluster.kmeans_lloyd(
            embeddings(spark, sf_dir), "embedding", iterations=ROUNDS, init=first_embeddings(spark, sf_dir)
        )
    )


def wssse(spark, sf_dir):
    centroids = cluster.kmeans_lloyd(points(spark, sf_dir), XY, iterations=ROUNDS, init=START)
    return cluster.wssse(points(spark, sf_dir), centroids, XY).select(F.round("wssse", -2).alias("wssse"))


def centroids_from_files(spark, sf_dir):
    """One round from centroids saved as text by the round before."""
    with scratch(spark, "centroids") as path:
        first = cluster.kmeans_step(points(spark, sf_dir), START, XY).orderBy("cid").coalesce(1)
        sinks.write_kv(first, path, "x", "y", mode="overwrite")
        saved = cluster.centroid_list(records.read_centroids(read_lines(spark, path)))
    return _xy(cluster.kmeans_step(points(spark, sf_dir), saved, XY))


def kmeans_drawn_start(spark, sf_dir):
    """Rounds from a start drawn from the points."""
    return _xy(cluster.kmeans_lloyd(points(spark, sf_dir), XY, K, ROUNDS, "drawn", SEED))


def kmeans_ml(spark, sf_dir):
    """How many vectors the model places, in how many clusters, and whether its error is that of its own placing."""
    vectors = records.read_vectors(_vector_lines(spark, sf_dir))
    model, error = cluster.kmeans_ml(vectors, K, ROUNDS, seed=SEED)
    centers = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])
    center = F.element_at(centers, F.col("prediction") + 1)
    gaps = F.zip_with(vector_to_array("features"), center, lambda a, b: (a - b) * (a - b))
    square = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)
    return model.transform(vectors).agg(
        F.count("prediction").alias("n"), F.count_distinct("prediction").alias("n_clusters"),
        (F.abs(F.sum(square) - F.lit(error)) <= 1e-9 * error).alias("error_agrees"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        points_from_csv, point_rejects, vectors_from_csv,
        kmeans_assign, kmeans_assign_points, kmeans_step, kmeans_lloyd, kmeans_lloyd_embeddings,
        wssse, centroids_from_files, kmeans_drawn_start, kmeans_ml,
    )
}

# -- the same in SQL --------------------------------------------------------

_POINTS = "points AS MATERIALIZED (SELECT row_number() OVER () AS id, l_quantity AS x, l_extendedprice AS y FROM lineitem)"
_START = f"c0 AS (SELECT * FROM (VALUES {', '.join(f'({i}, {x}, {y})' for i, (x, y) in START)}) AS t(cid, x, y))"


def _near(centroids: str) -> str:
    return f"""SELECT id, p.x, p.y, min({{'sq': (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y), 'cid': c.cid}}) AS near
  FROM points p CROSS JOIN {centroids} c GROUP BY id, p.x, p.y"""


def _drawn_steps(k: int, seed: int) -> str:
    """The start: of each turn, the point that has waited least for its squared distance from those before."""
    steps = []
    for turn in range(k):
        digest = f"md5('{seed}/{turn},' || x::VARCHAR || ',' || y::VARCHAR)"
        wait = f"-ln((('0x' || substr({digest}, 1, 13))::BIGINT::DOUBLE + 1) / {1 << 52}.0)"
        rows = "SELECT x, y, 1.0 AS sq FROM points"
        if turn:
            drawn = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(turn))
            rows = f"""SELECT p.x, p.y, min((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y)) AS sq
    FROM points p, ({drawn}) c GROUP BY p.id, p.x, p.y HAVING sq > 0"""
        steps.append(f"""s{turn} AS MATERIALIZED (
  SELECT {turn} AS cid, x, y FROM ({rows}) ORDER BY {wait} / sq, x, y LIMIT 1)""")
    return ",\n".join(steps) + ",\nc0 AS (" + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(k)) + ")"


def _lloyd_steps(iterations: int, start: str = _START) -> str:
    steps = [f"WITH {_POINTS}", start]
    for i in range(iterations):
        steps.append(
            f"c{i + 1} AS MATERIALIZED (SELECT near.cid AS cid, avg(x) AS x, avg(y) AS y "
            f"FROM ({_near(f'c{i}')}) GROUP BY near.cid)"
        )
    return ",\n".join(steps)


_XY_ROWS = "SELECT cid::INTEGER AS cid, round(x, 4) AS x, round(y, 4) AS y FROM "

_VECTORS = f"""vectors AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
e0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid, v FROM vectors ORDER BY vec_id LIMIT {K})"""


def _near_vectors(centroids: str) -> str:
    return f"""SELECT vec_id, any_value(p.v) AS v,
    min({{'sq': list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'cid': c.cid}}) AS near
  FROM vectors p CROSS JOIN {centroids} c GROUP BY vec_id"""


def _vector_steps(iterations: int) -> str:
    steps = [f"WITH {_VECTORS}"]
    for i in range(iterations):
        steps.append(
            f"""d{i + 1} AS MATERIALIZED (
  SELECT cid, dim, avg(x) AS value
  FROM (SELECT near.cid AS cid, unnest(range(len(v))) AS dim, unnest(v) AS x FROM ({_near_vectors(f'e{i}')}))
  GROUP BY cid, dim),
e{i + 1} AS MATERIALIZED (SELECT cid, list(value ORDER BY dim) AS v FROM d{i + 1} GROUP BY cid)"""
        )
    return ",\n".join(steps)


_DIM_ROWS = "SELECT cid::INTEGER AS cid, dim::INTEGER AS dim, round(value, 6) AS value FROM "

SQL = {
    "points_from_csv": "SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE l_linenumber <> 7",
    "point_rejects": """SELECT l_quantity || ',n/a,' || l_discount AS "value", count(*) AS n
FROM lineitem WHERE l_linenumber = 7 GROUP BY ALL""",
    "vectors_from_csv": """SELECT dim::INTEGER AS dim, count(*) AS n, min(value) AS low, max(value) AS high
FROM (SELECT unnest(range(len(v))) AS dim, unnest(v) AS value FROM (SELECT embedding::DOUBLE[] AS v FROM embeddings))
GROUP BY dim""",
    "kmeans_assign": f"""WITH {_VECTORS}
SELECT vec_id, near.cid::INTEGER AS cid, round(sqrt(near.sq), 6) AS dist FROM ({_near_vectors('e0')})""",
    "kmeans_assign_points": f"""WITH {_POINTS}, {_START}
SELECT x, y, near.cid::INTEGER AS cid, round(sqrt(near.sq), 4) AS dist FROM ({_near('c0')})""",
    "kmeans_step": f"{_vector_steps(1)} {_DIM_ROWS} d1",
    "kmeans_lloyd": f"{_lloyd_steps(ROUNDS)} {_XY_ROWS} c{ROUNDS}",
    "kmeans_drawn_start": f"{_lloyd_steps(ROUNDS, _drawn_steps(K, SEED))} {_XY_ROWS} c{ROUNDS}",
    "kmeans_ml": f"SELECT count(*) AS n, {K}::BIGINT AS n_clusters, true AS error_agrees FROM embeddings",
    "kmeans_lloyd_embeddings": f"{_vector_steps(ROUNDS)} {_DIM_ROWS} d{ROUNDS}",
    "wssse": f"{_lloyd_steps(ROUNDS)} SELECT round(sum(near.sq), -2) AS wssse FROM ({_near(f'c{ROUNDS}')})",
    "centroids_from_files": f"""{_lloyd_steps(2)}
SELECT n.place::INTEGER AS cid, round(x, 4) AS x, round(y, 4) AS y
FROM c2 JOIN (SELECT cid, row_number() OVER (ORDER BY x, y) - 1 AS place FROM c1) n USING (cid)""",
}
