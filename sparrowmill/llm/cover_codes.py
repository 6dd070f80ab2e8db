"""Vector codes: product quantisation whose Lloyd rounds run on cover trees.

A vector of whole numbers is cut into parts, and each part position has a
codebook. Every chunk of rows gets one cover tree per part position, built once
and stored: a node is a ball of points around one of them, its children cover
it with balls of half its radius, and it knows the count and the sum of its
points. A round looks at the trees level by level. Where the nearest entry is
nearer to every point of the ball than any other can be (the triangle
inequality), the whole subtree is assigned by its count and sum. Ambiguous nodes
hand over to their children, and only points of ambiguous leaves are compared
one by one. Everything that decides is exact: whole numbers, with a margin where
square roots are compared.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import sized_join, text_bytes
from ..session import cut_lineage, scratch_path
from . import int_vectors as V
from . import words as W

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CHUNK = 8192  # rows whose trees are one stored row
LEAF = 24  # points that are not divided further
MOST_CHILDREN = 96  # of a node; what they leave uncovered is one leaf


# --- the trees -------------------------------------------------------------


@dataclass
class Forest:
    """Cover trees, one for each part position, over the same rows. Nodes stand level by level."""

    points: np.ndarray  # (parts * rows, width), those of part 0 first
    order: np.ndarray  # of points; those of a node stand together
    low: np.ndarray  # of each node, in order
    high: np.ndarray
    center: np.ndarray  # a point of the node
    radius: np.ndarray
    child: np.ndarray  # the first child; the others follow
    children: np.ndarray  # how many; 0 for a leaf
    part: np.ndarray
    total: np.ndarray  # the sum of the node's points

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.__dataclass_fields__ if k != "points"}, points=_small(self.points))
        return out.getvalue()

    @classmethod
    def load(cls, payload: bytes) -> Forest:
        with np.load(io.BytesIO(payload)) as held:
            fields = {k: held[k] for k in cls.__dataclass_fields__}
        fields["points"] = fields["points"].astype(np.float64)
        return cls(**fields)


def _small(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max() if x.size else 0
    return x.astype(np.int16 if most < 1 << 15 else np.int32)


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def plant(rows: np.ndarray, parts: int, leaf: int = LEAF, most: int = MOST_CHILDREN) -> Forest:
    """The cover trees of ``rows``, each cut into ``parts`` equal parts."""
    n, width = len(rows), rows.shape[1] // parts
    points = rows.reshape(n, parts, width).transpose(1, 0, 2).reshape(parts * n, width).astype(np.float64)
    order = np.arange(parts * n)
    low, high = np.arange(parts) * n, (np.arange(parts) + 1) * n
    center, part, final = low.copy(), np.arange(parts), np.zeros(parts, bool)
    levels, made = [], 0
    while len(low):
        size = high - low
        far = np.zeros(len(low))
        inside = W.ranges(low, size)
        heads = np.cumsum(size) - size
        at = points[order[inside]]
        far = np.maximum.reduceat(_square(at - np.repeat(points[center], size, axis=0)), heads)
        total = np.add.reduceat(at, heads, axis=0)
        open_ = (size > leaf) & (far > 0) & ~final
        levels.append([low, high, center, np.sqrt(far), part, total, open_])
        made += len(low)
        low, high, center, part, final, counts = _divide(points, order, low, high, center, part, far, np.flatnonzero(open_), most)
        children = np.zeros(len(open_), np.int64)
        children[open_] = counts
        levels[-1].append(made + np.cumsum(children) - children)
        levels[-1].append(children)
    stacked = [np.concatenate([x[i] for x in levels]) for i in (0, 1, 2, 3, 7, 8, 4, 5)]
    return Forest(points, order.astype(np.int32), *stacked)


def _divide(points, order, low, high, center, part, far, nodes, most):
    """Children of ``nodes``: balls of half the radius, around points that no earlier ball covers."""
    none = np.zeros(0, np.int64)
    if not len(nodes):
        return none, none, none, none, np.zeros(0, bool), none
    size = (high - low)[nodes]
    inside = W.ranges(low[nodes], size)
    of = np.repeat(np.arange(len(nodes)), size)
    reach = far[nodes] / 4  # of half the radius, squared
    point = order[inside]
    child = np.full(len(inside), most, np.int64)
    centers = np.full((len(nodes), most + 1), -1, np.int64)
    centers[:, most] = center[nodes]
    left = np.arange(len(inside))
    for k in range(most):
        owner = of[left]
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        alive = owner[head]
        centers[alive, k] = center[nodes[alive]] if k == 0 else point[left[head]]
        gap = _square(points[point[left]] - points[centers[owner, k]])
        near = gap <= reach[owner]
        child[left[near]] = k
        left = left[~near]
        if not len(left):
            break
    key = of * (most + 1) + child
    sort = np.argsort(key, kind="stable")
    order[inside] = point[sort]
    key = key[sort]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    parent, kth = np.divmod(key[head], most + 1)
    begin = inside[head]
    count = np.diff(np.append(head, len(key)))
    return begin, begin + count, centers[parent, kth], part[nodes[parent]], kth == most, np.bincount(parent, minlength=len(nodes))


def nearest(forest: Forest, books: np.ndarray, each: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """``(counts, sums, codes)``: of each part and entry the points nearest to it and their sum.

    ``books`` is (parts, entries, width); the lower entry wins a tie. ``codes``,
    with ``each``, has the entry of every point, in the order of ``points``.
    """
    parts, entries, width = books.shape
    books = books.astype(np.float64)
    norms = np.einsum("pew,pew->pe", books, books)
    counts, sums = np.zeros(parts * entries), np.zeros((parts * entries, width))
    codes = np.zeros(len(forest.points), np.uint8) if each else None

    def add(slot: np.ndarray, weight: np.ndarray, total: np.ndarray) -> None:
        counts[:] += np.bincount(slot, weight, parts * entries)
        for i in range(width):
            sums[:, i] += np.bincount(slot, total[:, i], parts * entries)

    def squares(part: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
        """Of each part in turn the squared distances to its entries; ``part`` ascends."""
        edge = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edge)):
            at = slice(edge[p], edge[p + 1])
            yield p, at, norms[p] - 2 * (x[at] @ books[p].T)

    front, exact = np.flatnonzero(np.arange(len(forest.low)) < parts), []
    while len(front):
        x, part, radius = forest.points[forest.center[front]], forest.part[front], forest.radius[front]
        own = _square(x)
        best, sure = np.zeros(len(front), np.int64), np.zeros(len(front), bool)
        for _, at, d in squares(part, x):
            best[at] = d.argmin(axis=1)
            row = np.arange(len(d))
            first = np.sqrt(np.maximum(d[row, best[at]] + own[at], 0))
            d[row, best[at]] = np.inf
            second = np.sqrt(np.maximum(d.min(axis=1) + own[at], 0))
            # The margin is far above the rounding of the roots.
            sure[at] = (radius[at] == 0) | ((first + 2 * radius[at]) * (1 + 1e-12) + 1e-9 < second)
        done = front[sure]
        if len(done):
            size = forest.high[done] - forest.low[done]
            add(forest.part[done] * entries + best[sure], size, forest.total[done])
            if each:
                codes[forest.order[W.ranges(forest.low[done], size)]] = np.repeat(best[sure], size)
        rest = front[~sure]
        exact.append(rest[forest.children[rest] == 0])
        rest = rest[forest.children[rest] > 0]
        front = W.ranges(forest.child[rest], forest.children[rest])
    rest = np.concatenate(exact) if exact else np.zeros(0, np.int64)
    rest = rest[np.argsort(forest.part[rest], kind="stable")]
    size = forest.high[rest] - forest.low[rest]
    point = forest.order[W.ranges(forest.low[rest], size)]
    part = np.repeat(forest.part[rest], size)
    for p, at, d in squares(part, forest.points[point]):
        best = d.argmin(axis=1)
        add(p * entries + best, np.ones(len(best)), forest.points[point[at]])
        if each:
            codes[point[at]] = best
    return counts.reshape(parts, entries), sums.reshape(parts, entries, width), codes


# --- on Spark --------------------------------------------------------------


def store_trees(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, chunk: int = CHUNK) -> DataFrame:
    """``(ids, labels, trees)``: a row for every ``chunk`` usable vectors of a task, stored once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            ids, labels = (pa.concat_arrays([x[i] for x in held]) for i in (0, 1))
            trees = plant(np.concatenate([x[2] for x in held]), parts).dump()
            one = [0, len(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels), pa.array([trees], pa.binary())],
                ["ids", "labels", "trees"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                piece = batch.slice(at, chunk)
                good, rows = V.integers(piece.column(1))
                if rows.shape[1] % parts:
                    raise ValueError(f"vectors of {rows.shape[1]} numbers are not cut into {parts} equal parts")
                if len(rows):
                    mask = pa.array(good)
                    held.append((piece.column(0).filter(mask), piece.column(2).filter(mask), rows))
                    n += len(rows)
                if n >= chunk:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    schema = (
        T.StructType()
        .add("ids", T.ArrayType(vectors.schema[id_col].dataType))
        .add("labels", T.ArrayType(vectors.schema[label_col].dataType))
        .add("trees", "binary")
    )
    path = scratch_path(vectors.sparkSession, "cover-trees")
    (
        vectors.select(id_col, vector_col, label_col).mapInArrow(run, schema)
        .write.option("compression", "zstd").parquet(path)
    )
    return vectors.sparkSession.read.parquet(path)


def first_books(vectors: DataFrame, id_col: str, vector_col: str, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, width): the parts of the usable vectors of the smallest ids, ``entries`` rows at most.

    Rows of one id stand in the order of their vectors; null ids come last.
    """
    first = (
        vectors.where(V.usable(vector_col)).select(id_col, vector_col)
        .orderBy(F.col(id_col).asc_nulls_last(), vector_col).limit(entries)
    )
    rows = V.integers(first.select(vector_col).toArrow().column(0))[1]
    return rows.reshape(len(rows), parts, rows.shape[1] // parts).transpose(1, 0, 2)


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: componentwise ``floor(sum / count)``; unused entries stay.

    A task adds up all its trees and returns a row for each entry it used, so
    the driver gets ``parts * entries`` rows, whatever the input.
    """
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(books.shape[:2]), np.zeros(books.shape)
        for batch in batches:
            for payload in batch.column(0):
                more = nearest(Forest.load(payload.as_py()), books)
                counts += more[0]
                sums += more[1]
        part, entry = np.nonzero(counts)
        arrays = [pa.array(part), pa.array(entry), pa.array(counts[part, entry].astype(np.int64))]
        arrays += [pa.array(sums[part, entry, i].astype(np.int64)) for i in range(width)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]
    added = (
        trees.select("trees").mapInArrow(run, ", ".join(f"{x} long" for x in names))
        .groupBy("part", "entry").agg(*[F.sum(x).alias(x) for x in names[2:]])
    )
    out = books.copy()
    for part, entry, n, *total in added.collect():
        out[part, entry] = [x // n for x in total]
    return out


def coded(trees: DataFrame, books: np.ndarray, id_col: str, label_col: str) -> DataFrame:
    """``(id, label, code, error)`` of every stored vector: two hex digits a part, and the squared distance."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                forest = Forest.load(batch.column(2)[i].as_py())
                codes = nearest(forest, books, each=True)[2]
                gap = forest.points - books[np.repeat(np.arange(parts), len(codes) // parts), codes]
                error = _square(gap).reshape(parts, -1).astype(np.int64).sum(axis=0)
                text = codes.reshape(parts, -1).T.tobytes().hex()
                step = 2 * parts
                code = [text[k : k + step] for k in range(0, len(text), step)]
                arrays = [batch.column(k).slice(i, 1).flatten() for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(code, pa.string()), pa.array(error)], names)

    names = ["id", "label", "code", "error"]
    schema = T.StructType()
    for name, column in (("id", "ids"), ("label", "labels")):
        schema.add(name, trees.schema[column].dataType.elementType)
    schema.add("code", "string").add("error", "long")
    return trees.mapInArrow(run, schema)


def books_sha256(books: np.ndarray) -> str:
    """Of the whole numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.astype(np.int64).ravel().tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)``, a row per usable vector.

    Left out are rows whose vector is null or empty or holds null or non-finite
    components. A null id or label stays null; null labels add up together.
    Repeated rows count as often as they occur. With fewer than ``entries``
    usable vectors the codebooks are that much shorter; without any, or from an
    empty table, no row returns. Vectors of different lengths, or of a length
    that is no multiple of ``parts``, are an error. Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256, for two hex digits")
    vectors = vectors.select(id_col, vector_col, label_col)
    books = first_books(vectors, id_col, vector_col, parts, entries)
    trees = store_trees(vectors, id_col, vector_col, label_col, parts)
    for _ in range(rounds):
        books = lloyd_round(trees, books)
    # A string for each label, for null too, to join on.
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows = cut_lineage(coded(trees, books, id_col, label_col).select("id", "code", "error", label.alias("label")))
    sums = cut_lineage(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")))
    joined = sized_join(rows, sums, sums.agg(text_bytes("label")).first()[0], "label", "n", ["id", "code"])
    return joined.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )
