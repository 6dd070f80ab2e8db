"""Quality classifier: logistic regression over hashed word n-grams.

Training follows the regularised leader, one document at a time; scoring is a
sparse dot product. A document's features are its word 1- and 2-grams and the
1- to 3-grams of its word shapes (case, digits, symbols, a repeat of the word
before), hashed into a table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

BITS = 18  # of the feature table
MAX_TRAINING_ROWS = 10_000  # labelled documents that the model is fitted on, chosen by a hash of the id
THRESHOLD = 0.3

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_LOWER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one for each table place; the last is the bias
    bits: int


def _tokens(texts: pa.Array) -> W.Words:
    """Words cut further where letters or digits meet symbols."""
    words = W.split(texts)
    data = words.data
    plain = _UPPER[data] | _LOWER[data] | _DIGIT[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (plain[1:] != plain[:-1]) & ~W._BLANK[data[1:]] & ~W._BLANK[data[:-1]]
    cut[words.start] = True
    start = np.flatnonzero(cut[:-1])
    # A token ends where the next begins, or with its word.
    word = np.searchsorted(words.start, start, side="right") - 1
    stop = np.append(start[1:], len(data))
    if len(start):
        stop = np.minimum(stop, (words.start + words.length)[word])
    return W.Words(data, words.offsets, start, stop - start, np.searchsorted(start, words.offsets))


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(places, values, first)``: each text's features, of unit length together."""
    words = _tokens(texts)
    n_texts = len(words.first) - 1
    lower = W.Words(W._LOWER[words.data], words.offsets, words.start, words.length, words.first)
    names = lower.hashes()
    shape = np.zeros(len(names), dtype=np.uint64)
    for k, kind in enumerate((_UPPER, _LOWER, _DIGIT)):
        has = np.concatenate([[0], np.cumsum(kind[words.data], dtype=np.int64)])
        shape |= (has[words.start + words.length] > has[words.start]).astype(np.uint64) << np.uint64(k)
    symbols = shape == 0
    shape[symbols] = names[symbols]  # symbols stand for themselves
    repeat = np.zeros(len(names), dtype=bool)
    repeat[1:] = names[1:] == names[:-1]
    shape = W.combine(shape, repeat.astype(np.uint64))
    parts = []
    for salt, (base, size) in enumerate(((names, 1), (names, 2), (shape, 1), (shape, 2), (shape, 3)), 1):
        place = W.whole(words.first, size)
        grams = W.windows(base, size)[place] if len(place) else np.zeros(0, np.uint64)
        slot = W.combine(grams, np.full(len(grams), salt, np.uint64)) >> np.uint64(64 - bits)
        parts.append(words.text_of[place].astype(np.uint64) << np.uint64(32) | slot)
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    text = (keys >> np.uint64(32)).astype(np.int64)
    values = np.log1p(counts).astype(np.float32)
    norm = np.sqrt(np.bincount(text, values.astype(np.float64) ** 2, n_texts))
    first = np.searchsorted(text, np.arange(n_texts + 1))
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), (values / norm[text]).astype(np.float32), first


class FollowTheLeader:
    """Per-coordinate follow-the-regularised-leader updates of a logistic model."""

    def __init__(self, bits: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.02):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at = np.append(places, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        gradient = (_sigmoid(w @ x) - label) * x
        square = gradient * gradient
        step = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * w
        self.n[at] += square


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def held_out(id_col: str) -> Column:
    """Whether the id is set aside for testing; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bits: int = BITS,
    max_rows: int = MAX_TRAINING_ROWS,
    passes: int = 2,
) -> Model:
    """A model fitted on at most ``max_rows`` labelled documents that are not held out.

    Labels that are null or of a null or held-out id are left out, and an id
    with several labels takes the greatest. The sample is the ids of lowest
    hash, so it does not depend on partitioning. Features are made where the
    documents lie; one task then learns from the bounded sample, in its order.
    Without any label the model scores every text 0.5.
    """
    sample = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label_col).cast("int").alias("__label"))
        .withColumn("__order", F.xxhash64("__id"))
        .orderBy("__order", "__id")
        .limit(max_rows)
    )
    # At most max_rows rows of three numbers.
    rows = W.bounded(docs).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2):
            places, values, first = features(part.column(2), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1),
                    pa.ListArray.from_arrays(first.astype(np.int32), places),
                    pa.ListArray.from_arrays(first.astype(np.int32), values),
                ],
                ["order", "label", "places", "values"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, seen = FollowTheLeader(bits), []
        for batch in batches:
            label = batch.column(1).to_numpy()
            first = [c.offsets.to_numpy() for c in (batch.column(2), batch.column(3))]
            places, values = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            for i in range(batch.num_rows):
                seen.append(
                    (places[first[0][i] : first[0][i + 1]], values[first[1][i] : first[1][i + 1]], label[i])
                )
                leader.learn(*seen[-1])
        for _ in range(passes - 1):
            for row in seen:
                leader.learn(*row)
        yield pa.RecordBatch.from_arrays([pa.array([leader.weights().astype("<f4").tobytes()], pa.binary())], ["weights"])

    fitted = (
        rows.select("__order", "__label", "__text")
        .mapInArrow(featurise, "order long, label int, places array<int>, values array<float>")
        .repartition(1)
        .sortWithinPartitions("order")
        .mapInArrow(learn, "weights binary")
        .first()
    )
    weights = np.frombuffer(fitted[0], "<f4") if fitted else np.zeros((1 << bits) + 1, np.float32)
    return Model(weights, bits)


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    places, values, first = features(texts, model.bits)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    dots = np.bincount(text, model.weights[places].astype(np.float64) * values, len(first) - 1)
    return _sigmoid(dots + float(model.weights[-1]))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``(id, held_out, score, predicted)``, a row per input row.

    A null or empty text has no features and gets the score of the bias alone.
    Only the text enters the score. A null id stays null.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score_texts(model, part.column(2)))],
                [id_col, "held_out", "score"],
            )

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]).add("held_out", "boolean")
    return (
        W.bounded(docs).select(id_col, held_out(id_col).alias("held_out"), text_col)
        .mapInArrow(rate, schema.add("score", "double"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def accepted_documents(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score at least ``threshold``."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, at):
            yield part.filter(pa.array(score_texts(model, part.column(at)) >= threshold))

    return W.bounded(docs).mapInArrow(keep, docs.schema)
