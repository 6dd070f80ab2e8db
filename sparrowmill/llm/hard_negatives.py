"""Hard negatives by Kronecker-packed products.

Scores are inner products of vectors of whole numbers. The components of several
candidates, biased to be positive, stand in separate fields of one wide integer,
so that one multiplication per anchor component multiplies all of them; a sum
over the components then holds every candidate's score in a field of its own,
wide enough never to run over. Fields that fit 53 bits together are held in
float64, whose products and sums of such whole numbers are exact, and go through
the matrix product; larger numbers are held in Python's integers.

Anchors are taken in blocks of bounded size. Each block meets all rows twice:
once for the anchors' positives, once for the negatives between the bounds that
the positives set. A task keeps the best few per anchor of what it has read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import int_vectors as V
from . import words as W

POSITIVES = 5
NEGATIVES = 3
LEAST_SHARE, MOST_SHARE = 50, 95  # percent of the positive's score
BLOCK = 1 << 15  # anchors that meet all rows at a time
TILE = 1 << 21  # scores that are looked at together
EXACT_BITS = 53  # of a float64
WIDE_FIELDS = 32  # in one of Python's integers


# --- packed products -------------------------------------------------------


def field_bits(anchors: np.ndarray, rows: np.ndarray) -> int:
    """The width of a field that holds any sum of products of the biased components."""
    if not anchors.size or not rows.size:
        return 1
    spans = [int(x.max()) - min(0, int(x.min())) for x in (anchors, rows)]
    return max(1, (anchors.shape[1] * max(spans[0], 1) * max(spans[1], 1)).bit_length())


@dataclass
class Packed:
    """The rows of a tile in fields of wide integers, ready to be multiplied by any anchor that fits."""

    wide: np.ndarray  # (components, integers)
    fields: int  # of an integer
    bits: int  # of a field
    n: int
    bias: int
    sums: np.ndarray  # of each row's components

    @classmethod
    def of(cls, rows: np.ndarray, bits: int) -> Packed:
        fields = EXACT_BITS // bits
        exact = fields >= 2
        if not exact:
            fields = WIDE_FIELDS
        bias = -min(0, int(rows.min())) if rows.size else 0
        n, dims = rows.shape
        lifted = np.zeros((-(-n // fields) * fields, dims), np.int64)
        lifted[:n] = rows + bias
        lifted = lifted.reshape(-1, fields, dims)
        if exact:
            power = np.ldexp(1.0, bits * np.arange(fields))
            wide = np.einsum("qfd,f->dq", lifted.astype(np.float64), power)
        else:
            wide = np.zeros((dims, len(lifted)), object)
            for f in range(fields):
                wide += lifted[:, f].T.astype(object) << (bits * f)
        return cls(wide, fields, bits, n, bias, rows.sum(axis=1))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors, rows): the inner products. A field holds ``sum (a + p) (c + q)``, from which the biases are taken."""
        lift = -min(0, int(anchors.min())) if anchors.size else 0
        lifted = anchors + lift
        out = np.empty((len(anchors), self.wide.shape[1], self.fields), np.int64)
        if self.wide.dtype == object:
            product = lifted.astype(object) @ self.wide
            mask = (1 << self.bits) - 1
            for f in range(self.fields):
                out[:, :, f] = (product >> (self.bits * f)) & mask
        else:
            product = lifted.astype(np.float64) @ self.wide
            for f in range(self.fields - 1, 0, -1):
                power = float(1 << (self.bits * f))
                field = np.floor(product / power)
                product -= field * power
                out[:, :, f] = field
            out[:, :, 0] = product
        out = out.reshape(len(anchors), self.wide.shape[1] * self.fields)[:, : self.n]
        own = self.bias * anchors.sum(axis=1) + anchors.shape[1] * lift * self.bias
        out -= own[:, None]
        out -= (lift * self.sums)[None, :]
        return out


def tiles(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(anchor, row, scores)`` of blocks of the whole product, with the places where they begin."""
    if not len(anchors) or not len(rows):
        return
    peak = [int(np.abs(x).max()) for x in (anchors, rows)]
    if anchors.shape[1] * peak[0] * peak[1] >= 1 << 62:
        raise ValueError("inner products of these vectors exceed 64 bits")
    width = max(1, min(len(rows), 4096))
    height = max(1, TILE // width)
    for b in range(0, len(rows), width):
        some = rows[b : b + width]
        packed = Packed.of(some, field_bits(anchors, some))
        for a in range(0, len(anchors), height):
            yield a, b, packed.scores(anchors[a : a + height])


# --- the best few ----------------------------------------------------------


class Best:
    """Of each of some slots, the ``most`` rows of the highest score, of equal scores the smaller id."""

    def __init__(self, slots: int, most: int, floor: np.ndarray | None = None):
        self.most = most
        self.slot = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.bar = np.full(slots, np.iinfo(np.int64).min) if floor is None else floor.copy()
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows that may be among the best: those not below ``bar``."""
        if len(slot):
            self.waiting.append((slot, score, ids))
            self.size += len(slot)
            if self.size > 1 << 18:
                self.settle()

    def settle(self) -> None:
        parts = [(self.slot, self.score, self.id), *self.waiting]
        slot, score, ids = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        head = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
        rank = np.arange(len(slot)) - np.repeat(head, np.diff(np.append(head, len(slot))))
        kept = rank < self.most
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]
        last = rank[kept] == self.most - 1
        self.bar[self.slot[last]] = np.maximum(self.bar[self.slot[last]], self.score[last])
        self.waiting, self.size = [], 0


@dataclass
class Anchors:
    """A block of anchors, by label."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray

    def __post_init__(self) -> None:
        order = np.argsort(self.labels, kind="stable")
        self.ids, self.labels, self.rows = self.ids[order], self.labels[order], self.rows[order]


def _read(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, labels, rows)`` of the batches, by label."""
    for batch in batches:
        rows = V.integers(batch.column(2))[1]
        if not len(rows):
            continue
        if rows.shape[1] != dims:
            raise ValueError(f"vectors of different lengths: {dims} and {rows.shape[1]}")
        ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        order = np.argsort(labels, kind="stable")
        yield ids[order], labels[order], rows[order]


def _top(found: DataFrame, by: list[str], most: int, score: str, id_: str) -> DataFrame:
    """The first rows of each group, with their ``rank``; the tasks have kept a few of each."""
    window = Window.partitionBy(*by).orderBy(F.desc(score), id_)
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)


def positives_of(rows: DataFrame, block: Anchors, most: int = POSITIVES) -> DataFrame:
    """``(anchor, id, score, rank)``: the best rows of each anchor's own label; ``anchor`` is its place in ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.ids), most)
        for ids, labels, values in _read(batches, block.rows.shape[1]):
            for label in np.intersect1d(labels, block.labels):
                a0, a1 = np.searchsorted(block.labels, [label, label + 1])
                b0, b1 = np.searchsorted(labels, [label, label + 1])
                for a, b, score in tiles(block.rows[a0:a1], values[b0:b1]):
                    at = slice(a0 + a, a0 + a + len(score))
                    own = ids[b0 + b : b0 + b + score.shape[1]]
                    i, j = np.nonzero(score >= best.bar[at][:, None])
                    other = own[j] != block.ids[at][i]
                    i, j = i[other], j[other]
                    best.add(i + at.start, score[i, j], own[j])
            best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.id, best.score)], ["anchor", "id", "score"])

    return _top(rows.mapInArrow(run, "anchor long, id long, score long"), ["anchor"], most, "score", "id")


def negatives_of(
    rows: DataFrame,
    block: Anchors,
    anchor: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    most: int = NEGATIVES,
) -> DataFrame:
    """``(slot, id, score, rank)``: the best rows of other labels with scores from ``low`` to ``high``.

    A slot is a positive: ``anchor``, in ascending order, tells whose.
    """
    place = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    n_slots = int(place.max()) + 1 if len(place) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchor), most, low)
        slot_of = np.full((n_slots, len(block.ids)), -1, np.int64)
        slot_of[place, anchor] = np.arange(len(anchor))
        used = np.flatnonzero(slot_of[0] >= 0)
        lowest = np.iinfo(np.int64).max
        for ids, labels, values in _read(batches, block.rows.shape[1]):
            for a, b, score in tiles(block.rows[used], values):
                at = used[a : a + len(score)]
                own, other = ids[b : b + score.shape[1]], labels[b : b + score.shape[1]]
                for slots in slot_of[:, at]:
                    bar = np.where(slots >= 0, best.bar[slots], lowest)
                    top = np.where(slots >= 0, high[slots], -lowest)
                    i, j = np.nonzero((score >= bar[:, None]) & (score <= top[:, None]))
                    apart = other[j] != block.labels[at][i]
                    i, j = i[apart], j[apart]
                    best.add(slots[i], score[i, j], own[j])
            best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.id, best.score)], ["slot", "id", "score"])

    return _top(rows.mapInArrow(run, "slot long, id long, score long"), ["slot"], most, "score", "id")


# --- on Spark --------------------------------------------------------------

_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    label: Column | None = None,
    is_anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Of each anchor and each of its first ``positives`` other rows of its label,
    the first ``negatives`` rows of another label whose score is 50 to 95 % of
    the positive's. Higher scores come first, ties by smaller id. ``label``
    replaces the label column, ``is_anchor`` marks the anchors (all rows, if not
    given); both may use the columns of ``vectors``.

    Rows with a null id, label or vector, an empty vector, or a null or
    non-finite component take no part. Rows of one id are rows of their own, but
    none is a positive of another; a repeated anchor returns its rows again. An
    anchor without positives, a positive without negatives between its bounds
    (always so below a score of 0), and an empty table give no rows. Vectors of
    different lengths are an error. Other columns are ignored.
    """
    spark = vectors.sparkSession
    label = F.col(label_col) if label is None else label
    chosen = F.lit(True) if is_anchor is None else F.coalesce(is_anchor, F.lit(False))
    kept = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(vector_col).alias("vector"), chosen.alias("chosen"),
    ).where(V.usable("vector") & F.col("id").isNotNull() & F.col("label").isNotNull())
    rows = kept.select("id", "label", "vector")
    anchors = kept.where("chosen").select("id", "label", "vector")
    n_blocks = max(1, -(-anchors.count() // block))
    # Dealt evenly, so that a block is bounded whatever the ids; stored, because the dealing may differ from run to run.
    anchors = cut_lineage(anchors.repartition(n_blocks).withColumn("block", F.spark_partition_id()))
    path = scratch_path(spark, "hard-negatives")
    written = 0
    for k in range(n_blocks):
        table = anchors.where(F.col("block") == k).select("id", "label", "vector").toArrow()
        if not table.num_rows:
            continue
        own = Anchors(
            table.column("id").to_numpy(), table.column("label").to_numpy(), V.integers(table.column("vector"))[1]
        )
        found = positives_of(rows, own, positives).toPandas().sort_values(["anchor", "rank"])
        anchor, score, other = (found[c].to_numpy(np.int64) for c in ("anchor", "score", "id"))
        low, high = -((-LEAST_SHARE * score) // 100), (MOST_SHARE * score) // 100
        open_ = low <= high
        anchor, score, other, low, high = (x[open_] for x in (anchor, score, other, low, high))
        if not len(anchor):
            continue
        slots = spark.createDataFrame(
            pa.table({"slot": np.arange(len(anchor)), "anchor_id": own.ids[anchor], "positive_id": other, "positive_score": score})
        )
        hits = negatives_of(rows, own, anchor, low, high, negatives)
        # As many rows as the block has positives.
        named = hits.join(F.broadcast(slots), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        named.write.mode("append").parquet(path)
        written += 1
    return spark.read.schema(_SCHEMA).parquet(path) if written else spark.createDataFrame([], _SCHEMA)


def planted_labels(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label, moved on by one of ten where the id is divisible by 7."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
