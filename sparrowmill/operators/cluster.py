"""Nearest centroid, Lloyd's k-means, error sum, and Spark ML k-means.

``features`` is a list of number columns, or the name of one array column.
Centroids are ``k`` rows of numbers: a list of ``(cid, coordinates)``, or a
DataFrame with ``cid`` first and the coordinates (columns or one array) after.
They are the only thing brought to the driver, ``k`` rows in each round.

A point must have all its coordinates, finite ones, and a vector as many as the
centroids. One that has not stops the job, or is left out with
``on_bad="reject"``; ``point_ok`` tells which.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import check_on_bad, require
from ..session import cut_lineage, shuffled_into

Centroids = Sequence[tuple[int, Sequence[float]]]
Features = str | list[str]

MOST_TERMS = 64  # squares that one generated expression adds up
SCREENED_FROM = 32  # centroids, from which on a matrix product finds the few to compare exactly
BOUNDED_FROM = 64  # centroids, from which on Lloyd's rounds keep bounds for each point
STORED_EVERY = 5  # rounds


def centroid_list(centroids: Centroids | DataFrame) -> list[tuple[int, list[float]]]:
    """Centroids as a list in order of ``cid``; the ``k`` rows of a DataFrame come to the driver."""
    if isinstance(centroids, DataFrame):
        rows = [
            (r[0], r[1] if isinstance(r[1], (list, tuple)) else r[1:]) for r in centroids.collect()
        ]
    else:
        rows = list(centroids)
    out = sorted((int(cid), [float(v) for v in coords]) for cid, coords in rows)
    if len({cid for cid, _ in out}) < len(out):
        raise ValueError("two centroids have one cid")
    return out


def point_ok(features: Features, dims: int | None = None) -> Column:
    """Whether a point has all its coordinates, and all of them are finite; ``dims`` is the length of a vector."""
    limit = F.lit(float("inf"))

    def there(value: Column) -> Column:
        value = value.cast("double")
        return F.coalesce(~F.isnan(value) & (F.abs(value) != limit), F.lit(False))

    if isinstance(features, list):
        ok = F.lit(True)
        for name in features:
            ok = ok & there(F.col(name))
        return ok
    vector = F.col(features)
    size = F.size(vector) > 0 if dims is None else F.size(vector) == dims
    return F.coalesce(vector.isNotNull() & size & F.forall(vector, there), F.lit(False))


def _checked(points: DataFrame, features: Features, dims: int | None, on_bad: str) -> DataFrame:
    check_on_bad(on_bad)
    ok = point_ok(features, dims)
    if on_bad == "reject":
        return points.where(ok)
    shown = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    return points.where(require(ok, F.coalesce(shown.cast("string"), F.lit("null")), f"a point lacks one of its {dims or ''} coordinates"))


def _nearest_of_columns(features: list[str], centroids: list[tuple[int, list[float]]]) -> Column:
    candidates = []
    for cid, coords in centroids:
        square = F.lit(0.0)
        for name, value in zip(features, coords, strict=True):
            gap = F.col(name) - F.lit(value)
            square = square + gap * gap
        candidates.append(F.struct(square.alias("sq_dist"), F.lit(cid).alias("cid")))
    return F.array_min(F.array(*candidates))


def _row_search(points: list[np.ndarray]) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A function of rows: the least squared distance, the place of the nearest of ``points``, and a bound
    from below for the squared distance to the others.

    Coordinates are added in order, as the generated code for columns does it,
    so that both give the same numbers. Of many points, a matrix product leaves
    those that rounding may have put in the wrong order, mostly one, and these
    are compared in that way. The function is sent to workers whole.
    """
    centers = np.array(points, np.float64).reshape(len(points), -1)
    columns, norms, screened = np.ascontiguousarray(centers.T), (centers * centers).sum(axis=1), len(points) >= SCREENED_FROM
    unit = 4e-15 * (centers.shape[1] + 8)  # far above the rounding of a product of that many terms

    def exact(x: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        square = np.zeros(len(x))
        for i in range(x.shape[1]):
            gap = x[:, i] - columns[i, place]
            square += gap * gap
        return square

    def each(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.asfortranarray(x)
        best, second, place = np.full(len(x), np.inf), np.full(len(x), np.inf), np.zeros(len(x), dtype=np.int64)
        for i in range(len(centers)):
            square = exact(x, i)
            closer = square < best
            second = np.where(closer, best, np.minimum(second, square))
            best[closer] = square[closer]
            place[closer] = i
        return best, place, second

    def screen(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = (x * x).sum(axis=1)
        square = norms + own[:, None] - 2 * (x @ centers.T)
        margin = unit * (own + norms.max())
        least = square.min(axis=1)
        row, place = np.nonzero(square <= (least + 2 * margin)[:, None])
        found = exact(x[row], place)
        head = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        best = np.minimum.reduceat(found, head)
        # Of equal ones the first, which has the lowest place.
        winner = np.minimum.reduceat(np.where(found == best[row], place, len(centers)), head)
        square[np.arange(len(x)), winner] = np.inf
        return best, winner, np.maximum(square.min(axis=1) - margin, 0)

    def search(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not screened or not len(x):
            return each(x)
        step = max(1, (1 << 21) // len(centers))
        parts = [screen(x[i : i + step]) for i in range(0, len(x), step)]
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))

    return search


def _row_matrix(dims: int) -> Callable[[pa.Array], np.ndarray]:
    """A function that makes a matrix of an Arrow column of vectors, each ``dims`` finite numbers."""

    def matrix(column: pa.Array) -> np.ndarray:
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        if (lengths != dims).any():
            raise ValueError(f"vectors of {dims} numbers are wanted, one has {lengths[lengths != dims][0]}")
        x = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
        if not np.isfinite(x).all():
            raise ValueError("a point lacks one of its coordinates")
        return x

    return matrix


def _nearest_of_array(feature: Column, centroids: list[tuple[int, list[float]]]) -> Column:
    ids, dims = np.array([cid for cid, _ in centroids], dtype=np.int32), len(centroids[0][1])
    search = _row_search([np.array(coords) for _, coords in centroids])

    @F.pandas_udf("sq_dist double, cid int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if any(v is None or len(v) != dims for v in batch):
                raise ValueError(f"vectors of {dims} numbers are wanted")
            x = np.array([np.asarray(v, np.float64) for v in batch]).reshape(-1, dims)
            if not np.isfinite(x).all():
                raise ValueError("a point lacks one of its coordinates")
            best, place, _ = search(x)
            yield pd.DataFrame({"sq_dist": best, "cid": ids[place]})

    return nearest(feature)


def nearest(features: Features, centroids: Centroids) -> Column:
    """``STRUCT<sq_dist, cid>`` of the nearest centroid; the lowest ``cid`` wins a tie.

    The points must have all their coordinates (``point_ok``). Number columns stay in generated code while that is short. Otherwise, and
    for an array column, the distances of a batch of rows are taken at once in
    numpy, several times faster than an element-wise expression over arrays.
    """
    centroids = centroid_list(centroids)
    if isinstance(features, str):
        return _nearest_of_array(F.col(features), centroids)
    if len(centroids) * len(features) > MOST_TERMS:
        return _nearest_of_array(F.array(*[F.col(c).cast("double") for c in features]), centroids)
    return _nearest_of_columns(features, centroids)


def _prepared(points: DataFrame, centroids: Centroids | DataFrame, features: Features, on_bad: str):
    found = centroid_list(centroids)
    dims = len(found[0][1]) if found else None
    return _checked(points, features, dims, on_bad), found


def kmeans_assign(
    points: DataFrame, centroids: Centroids | DataFrame, features: Features, on_bad: str = "fail"
) -> DataFrame:
    """The points with ``cid`` of the nearest centroid and the distance ``dist`` to it."""
    points, found = _prepared(points, centroids, features, on_bad)
    return (
        points.withColumn("__nearest", nearest(features, found))
        .select("*", F.col("__nearest.cid").alias("cid"), F.sqrt("__nearest.sq_dist").alias("dist"))
        .drop("__nearest")
    )


def kmeans_update(assigned: DataFrame, features: Features) -> DataFrame:
    """``(cid, coordinates...)``: the mean of the points of each cluster.

    The means come under the names of ``features``; an array column gives one
    array. Clusters without points have no row.
    """
    if isinstance(features, list):
        return assigned.groupBy("cid").agg(*[F.avg(c).alias(c) for c in features])
    return (
        assigned.select("cid", F.posexplode(features).alias("dim", "value"))
        .groupBy("cid", "dim")
        .agg(F.avg("value").alias("mean"))
        .groupBy("cid")
        .agg(F.sort_array(F.collect_list(F.struct("dim", "mean"))).alias("means"))
        .select("cid", F.col("means.mean").alias(features))
    )


def kmeans_step(
    points: DataFrame, centroids: Centroids | DataFrame, features: Features, on_bad: str = "fail"
) -> DataFrame:
    """One round: assign every point, then take the mean of each cluster."""
    if isinstance(features, list):
        return kmeans_update(kmeans_assign(points, centroids, features, on_bad), features)
    points, found = _prepared(points, centroids, features, on_bad)
    return _means(_array_sums(points, found, features), features)


def _means(sums: DataFrame, feature: str) -> DataFrame:
    return (
        sums.groupBy("cid", "dim")
        .agg((F.sum("total") / F.sum("n")).alias("mean"))
        .groupBy("cid")
        .agg(F.sort_array(F.collect_list(F.struct("dim", "mean"))).alias("means"))
        .select("cid", F.col("means.mean").alias(feature))
    )


def _array_sums(points: DataFrame, centroids: list[tuple[int, list[float]]], feature: str) -> DataFrame:
    """``(cid, dim, total, n)`` of each task's points."""
    ids, k, dims = np.array([cid for cid, _ in centroids], np.int32), len(centroids), len(centroids[0][1])
    search, matrix = _row_search([np.array(c) for _, c in centroids]), _row_matrix(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, members = np.zeros((k, dims)), np.zeros(k, np.int64)
        for batch in batches:
            x = matrix(batch.column(0))
            place = search(x)[1]
            np.add.at(totals, place, x)
            members += np.bincount(place, minlength=k)
        used = np.flatnonzero(members)
        columns = [
            pa.array(np.repeat(ids[used], dims)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))),
            pa.array(totals[used].ravel()), pa.array(np.repeat(members[used], dims)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cid", "dim", "total", "n"])

    return points.select(feature).mapInArrow(run, "cid int, dim int, total double, n long")


_STATE = (
    "vector array<double>, at int, upper double, lower double, cid int, dim int, total double, n long, searched long"
)


def _bounded_round(
    state: DataFrame, before: list[tuple[int, list[float]]] | None, centroids: list[tuple[int, list[float]]]
) -> DataFrame:
    """One assignment with bounds: the points with what is known of them, and each task's sums.

    A point keeps its centroid ``at``, and bounds for its distance to it
    (``upper``) and to all others (``lower``). The moves of the centroids since
    ``before`` loosen them; while the first stays below the second, or does so
    once measured anew, nothing is searched, and the search would have found the
    same. ``searched`` counts the points for which it was needed.
    """
    ids, dims = np.array([cid for cid, _ in centroids], np.int32), len(centroids[0][1])
    centers = np.array([c for _, c in centroids], np.float64)
    search, matrix = _row_search(list(centers)), _row_matrix(dims)
    moved = np.zeros(len(ids))
    if before is not None:
        known = dict(before)
        moved = np.sqrt(((centers - np.array([known[c] for c in ids.tolist()])) ** 2).sum(axis=1))
    order = np.argsort(-moved)
    others = np.full(len(ids), moved[order[0]])  # the farthest that any other centroid has moved
    others[order[0]] = moved[order[1]] if len(ids) > 1 else 0.0
    names = [field.split()[0] for field in _STATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, members, searched = np.zeros(centers.shape), np.zeros(len(ids), np.int64), 0
        for batch in batches:
            x = matrix(batch.column(0))
            place = np.full(len(x), -1)
            upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
            if batch.num_columns > 1:
                place = np.searchsorted(ids, batch.column(1).to_numpy())
                upper = batch.column(2).to_numpy() + moved[place]
                lower = batch.column(3).to_numpy() - others[place]
                # Bounds are compared with a margin far above their rounding.
                loose = np.flatnonzero(upper * (1 + 1e-9) + 1e-300 >= lower)
                upper[loose] = np.sqrt(((x[loose] - centers[place[loose]]) ** 2).sum(axis=1))
            rest = np.flatnonzero(upper * (1 + 1e-9) + 1e-300 >= lower)
            best, found, second = search(x[rest])
            place[rest], upper[rest], lower[rest] = found, np.sqrt(best), np.sqrt(second)
            searched += len(rest)
            np.add.at(totals, place, x)
            members += np.bincount(place, minlength=len(ids))
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dims), pa.array(x.ravel()))
            nothing = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([vectors, pa.array(ids[place]), pa.array(upper), pa.array(lower), *nothing], names)
        used = np.flatnonzero(members)
        n = len(used) * dims
        nothing = [pa.nulls(n, t) for t in (pa.list_(pa.float64()), pa.int32(), pa.float64(), pa.float64())]
        first = np.zeros(n, np.int64)
        first[:1] = searched
        yield pa.RecordBatch.from_arrays(
            [
                *nothing, pa.array(np.repeat(ids[used], dims)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))),
                pa.array(totals[used].ravel()), pa.array(np.repeat(members[used], dims)), pa.array(first),
            ],
            names,
        )

    return state.mapInArrow(run, _STATE)


def _bounded_rounds(
    points: DataFrame, feature: str, centroids: list[tuple[int, list[float]]], iterations: int, searched: list[int] | None = None
) -> list[tuple[int, list[float]]]:
    """The centroids after some rounds; the points' bounds are carried from one to the next."""
    state, before, held = points.select(F.col(feature).cast("array<double>").alias("vector")), None, None
    try:
        for done in range(1, iterations + 1):
            both = _bounded_round(state, before, centroids)
            both = cut_lineage(both) if done % STORED_EVERY == 0 else both.persist(StorageLevel.MEMORY_AND_DISK)
            sums = both.where("n IS NOT NULL")
            before, centroids = centroids, centroid_list(_means(sums, feature))
            if searched is not None:
                searched.append(sums.agg(F.sum("searched")).first()[0] or 0)
            if held is not None:
                held.unpersist()
            held, state = both, both.where("vector IS NOT NULL").select("vector", "at", "upper", "lower")
            if not centroids:
                break
    finally:
        if held is not None:
            held.unpersist()
    return centroids


def random_centroids(spark: SparkSession, k: int, dims: int, seed: int) -> list[tuple[int, list[float]]]:
    """``k`` random starts along the diagonal: coordinates in ``i - k/2 + [0, 1)``."""
    drawn = spark.range(0, k, 1, 1).select(
        "id",
        F.array(*[F.col("id") - F.lit(k // 2) + F.rand(seed + d) for d in range(dims)]).alias("coords"),
    )
    return centroid_list(drawn)


def _race(features: Features, seed: int, turn: int) -> Column:
    """A waiting time drawn from the coordinates alone: exponentially distributed, the same for equal points.

    52 bits of the MD5 of the numbers as text make a number in (0, 1].
    """
    if isinstance(features, str):
        numbers = F.array_join(F.transform(features, lambda v: v.cast("double").cast("string")), ",")
    else:
        numbers = F.concat_ws(",", *[F.col(c).cast("double").cast("string") for c in features])
    digest = F.md5(F.concat(F.lit(f"{seed}/{turn},"), numbers))
    share = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(1 << 52))
    return -F.log(share)


def drawn_centroids(
    points: DataFrame, features: Features, k: int, seed: int = 0, per_turn: int | None = None
) -> list[tuple[int, list[float]]]:
    """``k`` of the points as starting centroids, drawn far apart; the same however the points are partitioned.

    In every turn each distinct point waits for a time drawn from its
    coordinates, divided by its squared distance from what has been drawn, and
    the first one is taken: chances in proportion to the squared distance, with
    one aggregate over all points a turn. Many centroids are drawn ``per_turn``
    at a time (by default so that sixteen turns do). Fewer than ``k`` distinct
    points are all drawn.
    """
    coords = [features] if isinstance(features, str) else features
    per_turn = per_turn or -(-k // 16)
    drawn: list[tuple[int, list[float]]] = []
    turn = 0
    while len(drawn) < k:
        wait = _race(features, seed, turn)
        rows = points
        if drawn:
            rows = rows.withColumn("__nearest", nearest(features, drawn)).where("__nearest.sq_dist > 0")
            wait = wait / F.col("__nearest.sq_dist")
        row = F.struct(wait.alias("wait"), *coords)
        n = min(per_turn, k - len(drawn))
        if n == 1:
            taken = [r[0] for r in rows.agg(F.min(row)).collect() if r[0] is not None]
        else:
            taken = rows.select(row.alias("row")).distinct().orderBy("row").limit(n).select("row.*").collect()
        if not taken:
            break
        for r in taken:
            values = r[1] if isinstance(features, str) else r[1:]
            drawn.append((len(drawn), [float(v) for v in values]))
        turn += 1
    return drawn


def kmeans_lloyd(
    points: DataFrame,
    features: Features,
    k: int = 6,
    iterations: int = 10,
    init: Centroids | DataFrame | str | None = None,
    seed: int = 0,
    on_bad: str = "fail",
) -> DataFrame:
    """``(cid, coordinates...)`` after a fixed number of rounds.

    A cluster left without points vanishes, so fewer than ``k`` may remain.
    ``init`` gives the starting centroids, or ``"drawn"`` has them drawn from
    the points; without it they are random. With very many centroids of an array
    column, bounds are carried from round to round that spare most searches.
    """
    spark = points.sparkSession
    wanted = [features] if isinstance(features, str) else features
    kept = points.select(*wanted)
    dims = len(features) if isinstance(features, list) else None
    if dims is None:
        first = kept.where(point_ok(features)).first()
        dims = len(first[0]) if first else None
    kept = _checked(kept, features, dims, on_bad).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if init is None:
            centroids = random_centroids(spark, k, dims or 0, seed)
        elif isinstance(init, str):
            if init != "drawn":
                raise ValueError(f"init must be centroids or 'drawn', not {init!r}")
            centroids = drawn_centroids(kept, features, k, seed)
        else:
            centroids = centroid_list(init)
        if isinstance(features, str) and len(centroids) >= BOUNDED_FROM:
            centroids = _bounded_rounds(kept, features, centroids, iterations)
        else:
            for _ in range(iterations):
                if not centroids:  # none are left if there are no points
                    break
                if isinstance(features, str):
                    step = _means(_array_sums(kept, centroids, features), features)
                else:
                    step = kmeans_update(kept.select("*", nearest(features, centroids)["cid"].alias("cid")), features)
                centroids = centroid_list(step)
    finally:
        kept.unpersist()
    if isinstance(features, str):
        return spark.createDataFrame(centroids, f"cid int, {features} array<double>")
    schema = ", ".join(["cid int", *[f"{c} double" for c in features]])
    return spark.createDataFrame([(cid, *coords) for cid, coords in centroids], schema)


def wssse(
    points: DataFrame, centroids: Centroids | DataFrame, features: Features, on_bad: str = "fail"
) -> DataFrame:
    """One row ``(wssse)``: the sum of squared distances to the nearest centroid."""
    points, found = _prepared(points, centroids, features, on_bad)
    return points.select(nearest(features, found).alias("nearest")).agg(F.sum("nearest.sq_dist").alias("wssse"))


def kmeans_ml(
    vectors: DataFrame, k: int = 6, max_iter: int = 10, seed: int = 0, features_col: str = "features",
    partitions: int | None = None,
) -> tuple[KMeansModel, float]:
    """A Spark ML model with parallel initialisation, and the error sum of its centers on the input.

    (The model's own summary has the error of the round before the last means.)

    The initialisation draws by partition and row; the vectors are therefore
    laid out by a hash of what they hold, in sorted ``partitions`` (as many as a
    shuffle has), so that the draws do not depend on how they came.
    """
    held = F.xxhash64(F.col(features_col).cast("string"))
    n = partitions or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with shuffled_into(vectors.sparkSession, n):
        kept = (
            vectors.select(features_col, held.alias("__held")).repartition(n, "__held").sortWithinPartitions("__held")
            .select(features_col).persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col).fit(kept)
            centers = [(i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
            arrays = kept.select(vector_to_array(features_col).alias("vector"))
            return model, wssse(arrays, centers, "vector").first()[0]
        finally:
            kept.unpersist()
