"""Language-model scores by masked pseudo-likelihood.

Every word is masked in turn and predicted from the words on both sides; the
summed conditional log-probabilities of all words score a document. A small
window network gives the word's class from the classes around: the most
frequent places of a hashed table have a class each, the others share classes of
like mass. A word has its share of its class, and this is the prior of what the
neighbours say: from each of the two adjacent words, the words seen beside it in
the corpus, the masked occurrence left out, are counted over the prior,

``p(w | sides) = mean over both sides of (pairs(side, w) + PRIOR * net(w)) / (pairs(side, any) + PRIOR)``

which adds up to one over all words of the corpus. Words and pairs are told
apart by 52-bit hashes and their counts grow with the corpus; no task holds
more of them than a block of documents asks for, or one shard of the table.

The counts are taken over all documents, and every document trains the network.
Tasks train on their own rows from the same start, in numpy, and the network is
the mean of theirs by words seen; the first, smaller fold of the documents
gives the second fold its start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

BITS = 20  # of the word table
OWN_CLASSES = 64
SHARED_CLASSES = 32
WIDTH = 16
SIDE = 2  # words seen on each side
FIRST_FOLD = 8  # one document in so many trains the start of the others
BATCH = 2048
RATE = 0.05
PRIOR = 32.0  # how many pairs the network's word is worth
KEY_BITS = 52  # of a word or a pair
BLOCK_BYTES = 8 << 20  # text scored at once, and the measure of the table's shards
_SMOOTH = 0.5
_EDGE = np.uint64(0xA5A5F00DC0FFEE11)  # stands beside the first and the last word
_WORD = W.salt(11)


@dataclass(frozen=True)
class Classes:
    of: np.ndarray  # uint8: the class of each table place
    log_share: np.ndarray  # float32: log p(place | class)
    mass: np.ndarray  # float64: the words of each class in the corpus

    @property
    def n(self) -> int:
        return int(self.of.max()) + 1


@dataclass
class Network:
    """``softmax(tanh(sum of side embeddings + bias) @ out + out_bias)``"""

    sides: np.ndarray  # (2 * SIDE, classes + 1, WIDTH); the last class is the edge of the text
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, n_classes: int, log_mass: np.ndarray, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        return cls(
            r.normal(0, 0.3, (2 * SIDE, n_classes + 1, WIDTH)).astype(np.float32),
            np.zeros(WIDTH, np.float32),
            r.normal(0, 0.1, (WIDTH, n_classes)).astype(np.float32),
            log_mass.astype(np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.sides, self.bias, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def with_flat(self, values: np.ndarray) -> Network:
        out, at = [], 0
        for p in self.parameters():
            out.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(*out)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.bias + self.sides[0][around[0]]
        for k in range(1, len(around)):
            total += self.sides[k][around[k]]
        return np.tanh(total)

    def log_probabilities(self, around: np.ndarray) -> np.ndarray:
        # The product of single numbers would be rounded by where a word stands.
        logits = (self.hidden(around).astype(np.float64) @ self.out.astype(np.float64)).astype(np.float32) + self.out_bias
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        return logits

    def learn(self, around: np.ndarray, target: np.ndarray, squares: list[np.ndarray]) -> None:
        """One step of gradient descent with a rate for each parameter."""
        h = self.hidden(around)
        logits = h @ self.out + self.out_bias
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(target)), target] -= 1.0
        p /= np.float32(len(target))
        back = (p @ self.out.T) * (1.0 - h * h)
        sides = np.empty_like(self.sides)
        for k in range(len(around)):
            hot = np.zeros((self.sides.shape[1], len(target)), np.float32)
            hot[around[k], np.arange(len(target))] = 1.0
            sides[k] = hot @ back
        for value, gradient, square in zip(
            self.parameters(), [sides, back.sum(0), h.T @ p, p.sum(0)], squares, strict=True
        ):
            square += gradient * gradient
            value -= np.float32(RATE) * gradient / (np.sqrt(square) + np.float32(1e-6))


def _slots(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    words = W.split(texts, lower=True)
    return (words.hashes() >> np.uint64(64 - bits)).astype(np.int64), words.first


def _around(classes: np.ndarray, first: np.ndarray, edge: int) -> np.ndarray:
    """``(2 * SIDE, words)``: the classes on both sides of each word; beyond its text the edge class."""
    n = len(classes)
    place = np.arange(n)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low, high = first[:-1][text], first[1:][text]
    out = np.full((2 * SIDE, n), edge, np.int64)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = place + shift
        there = (at >= low) & (at < high)
        out[k, there] = classes[at[there]]
    return out


def word_classes(docs: DataFrame, text_col: str = "text", bits: int = BITS) -> Classes:
    """The classes from the counts of all documents.

    A task sends a row for each table place it met; the driver gets one for each
    place of the table at most, as Arrow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for part in W.slices(batches, 0):
            total += np.bincount(_slots(part.column(0), bits)[0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "n"])

    rows = docs.select(text_col).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << bits, np.int64)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return classes_of(counts)


def classes_of(counts: np.ndarray) -> Classes:
    order = np.lexsort((np.arange(len(counts)), -counts))
    of = np.empty(len(counts), np.uint8)
    own = min(OWN_CLASSES, len(counts) // 2)
    of[order[:own]] = np.arange(own)
    rest = order[own:]
    mass = np.cumsum(counts[rest] + _SMOOTH)
    of[rest] = own + np.minimum((mass / mass[-1] * SHARED_CLASSES).astype(np.int64), SHARED_CLASSES - 1)
    smooth = counts + _SMOOTH
    total = np.bincount(of, smooth)
    mass = np.bincount(of, counts).astype(np.float64)
    return Classes(of, np.log(smooth / total[of]).astype(np.float32), mass)


def train(docs: DataFrame, classes: Classes, text_col: str = "text", bits: int = BITS) -> Network:
    """The network after every document has trained it once. Without words it predicts all classes alike."""
    n_classes = classes.n
    network = Network.start(n_classes, np.zeros(n_classes))
    fold = F.pmod(F.xxhash64(text_col), F.lit(FIRST_FOLD)) == 0
    for rows in (docs.where(fold), docs.where(~fold)):
        start = network

        def learn(batches: Iterator[pa.RecordBatch], start: Network = start) -> Iterator[pa.RecordBatch]:
            mine = start.with_flat(start.flat())
            squares = [np.zeros_like(p) for p in mine.parameters()]
            seen = 0
            for part in W.slices(batches, 0):
                slots, first = _slots(part.column(0), bits)
                known = classes.of[slots].astype(np.int64)
                around = _around(known, first, n_classes)
                # Words of a step come from all over the slice.
                steps = max(1, len(known) // BATCH)
                for k in range(steps if len(known) else 0):
                    mine.learn(around[:, k::steps], known[k::steps], squares)
                seen += len(known)
            if seen:
                values = mine.flat().astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values), pa.array(np.full(len(values), seen))],
                    ["at", "value", "words"],
                )

        # As many rows reach the driver as the network has parameters, about eight thousand.
        found = (
            rows.select(text_col)
            .mapInArrow(learn, "at int, value double, words long")
            .groupBy("at")
            .agg((F.sum("value") / F.sum("words")).alias("value"))
            .toArrow()
        )
        if found.num_rows:
            values = np.empty(found.num_rows)
            values[found.column("at").to_numpy()] = found.column("value").to_numpy()
            network = network.with_flat(values)
    return network


def _class_scores(slots: np.ndarray, first: np.ndarray, classes: Classes, network: Network) -> np.ndarray:
    """``log p(class | sides)`` of each word."""
    known = classes.of[slots].astype(np.int64)
    around = _around(known, first, classes.n)
    value = np.empty(len(known))
    for a in range(0, len(known), BATCH):
        log_p = network.log_probabilities(around[:, a : a + BATCH])
        value[a : a + BATCH] = log_p[np.arange(len(log_p)), known[a : a + BATCH]]
    return value


def score_texts(texts: pa.Array, classes: Classes, network: Network, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(n_words, summed log-probability)`` of each text by the network alone: the prior of ``score_block``."""
    slots, first = _slots(texts, bits)
    value = _class_scores(slots, first, classes, network)
    value += classes.log_share[slots]
    return np.diff(first), W.sums(value, first)


@dataclass
class Pairs:
    """The keys of a block's words and adjacent pairs, ascending, and how often the block has them.

    The columns of ``counts`` are all occurrences, those that open a text, and
    those that end one; the last two are for words only.
    """

    keys: np.ndarray  # uint64 below 2 ** KEY_BITS
    counts: np.ndarray  # int64 (keys, 3)
    word: np.ndarray  # the key of each word, and that of the edge
    pair: np.ndarray  # the key of each word with the one before, then of each text's last word with the edge
    hashes: np.ndarray  # of the words
    first: np.ndarray
    heads: np.ndarray  # first words of texts
    tails: np.ndarray  # last ones


def pairs_of(texts: pa.Array) -> Pairs:
    words = W.split(texts, lower=True)
    h, first = words.hashes(), words.first
    some = np.diff(first) > 0
    heads, tails = first[:-1][some], first[1:][some] - 1
    distinct, word = _encoded(h)
    edge = len(distinct)
    distinct = np.append(distinct, _EDGE)
    before = np.empty(len(h), np.int64)
    before[1:] = word[:-1]
    before[heads] = edge
    couples, pair = _encoded(np.concatenate([before << 32 | word, word[tails] << 32 | edge]))
    counts = np.zeros((len(distinct) + len(couples), 3), np.int64)
    for column, of in enumerate((word, word[heads], word[tails])):
        counts[: edge + 1, column] = np.bincount(of, minlength=edge + 1)
    counts[edge, 0] = len(heads)
    counts[edge + 1 :, 0] = np.bincount(pair, minlength=len(couples))
    keys = W.combine(np.append(distinct, distinct[couples >> 32]), np.append(np.full(edge + 1, _WORD), distinct[couples & 0xFFFFFFFF]))
    keys >>= np.uint64(64 - KEY_BITS)
    order = np.argsort(keys)
    place = np.empty(len(keys), np.int32)
    place[order] = np.arange(len(keys), dtype=np.int32)
    return Pairs(keys[order], counts[order], place[np.append(word, edge)], place[edge + 1 + pair], h, first, heads, tails)


def _encoded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and which one each is."""
    codes = pa.array(values).dictionary_encode()
    return codes.dictionary.to_numpy(), codes.indices.to_numpy().astype(np.int64)


def score_block(
    texts: pa.Array, classes: Classes, network: Network, known: tuple[np.ndarray, np.ndarray] | None = None, bits: int = BITS
) -> tuple[np.ndarray, np.ndarray]:
    """``(n_words, summed log-probability)`` of each text.

    ``known`` has keys of the block with their counts in the corpus, where these
    are more than in the block.
    """
    block = pairs_of(texts)
    total = block.counts
    if known is not None and len(known[0]):
        total[np.searchsorted(block.keys, known[0])] = known[1]
    slots = (block.hashes >> np.uint64(64 - bits)).astype(np.int64)
    value = _class_scores(slots, block.first, classes, network)
    n = len(value)
    word, edge = block.word[:-1], block.word[-1]
    prior = PRIOR * np.exp(value) * total[word, 0] / classes.mass[classes.of[slots]]
    # The word before and its pairs with any word, the word after likewise; the masked occurrence is not there.
    before, after = np.empty(n), np.empty(n)
    before[1:], after[:-1] = (total[word, 0] - total[word, 2])[:-1], (total[word, 0] - total[word, 1])[1:]
    before[block.heads], after[block.tails] = total[edge, 0], total[edge, 0]
    left = total[block.pair, 0]
    right = np.empty(n)
    right[:-1] = left[1:n]
    right[block.tails] = left[n:]
    p = (left[:n] - 1 + prior) / (before - 1 + PRIOR) + (right - 1 + prior) / (after - 1 + PRIOR)
    # Single precision, so that a sum does not depend on what stands before it.
    value = np.log(p / 2).astype(np.float32).astype(np.float64)
    return np.diff(block.first), W.sums(value, block.first)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts, byte by byte, compressed."""
    columns = np.stack([np.diff(keys, prepend=np.uint64(0)), *counts.T.astype(np.uint64)])
    planes = columns.view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, 8, -1).transpose(0, 2, 1)
    columns = np.ascontiguousarray(planes).view("<u8")[..., 0]
    return np.cumsum(columns[0], dtype=np.uint64), columns[1:].T.astype(np.int64)


def _zipped(texts: pa.Array) -> pa.Array:
    packer = zstandard.ZstdCompressor(level=1)
    return pa.array([packer.compress(x) for x in W.texts_of(texts)], pa.binary())


def _unzipped(data: pa.ChunkedArray) -> pa.Array:
    return pa.array([zstandard.decompress(x) for x in data.to_pylist()], pa.large_binary())


def _corpus_counts(blocks: DataFrame, n_shards: int) -> DataFrame:
    """``(block, data)``: for each block, packed, those of its keys that the corpus has more often than the block.

    Keys are dealt out by range; a task merges one shard of what every block sent.
    """

    def send(part: pa.Table) -> pa.Table:
        found = pairs_of(_unzipped(part.column("text")))
        shard = (found.keys >> np.uint64(KEY_BITS - 32)) * np.uint64(n_shards) >> np.uint64(32)
        cuts = np.searchsorted(shard.astype(np.int64), np.arange(n_shards + 1))
        some = np.flatnonzero(np.diff(cuts))
        data = [_packed(found.keys[cuts[i] : cuts[i + 1]], found.counts[cuts[i] : cuts[i + 1]]) for i in some]
        block = np.full(len(some), part.column("block")[0].as_py())
        return pa.table({"shard": pa.array(some.astype(np.int32)), "block": pa.array(block.astype(np.int32)), "data": pa.array(data, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, keys, counts = [], [], []
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                k, n = _unpacked(data)
                owner.append(block)
                keys.append(k)
                counts.append(n)
        if not owner:
            return
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        each = np.concatenate(counts)
        total = np.stack([np.bincount(place, x, len(every)).astype(np.int64) for x in each.T], 1)
        at = 0
        for block, k, n in zip(owner, keys, counts, strict=True):
            all_of_it = total[place[at : at + len(k)]]
            at += len(k)
            more = all_of_it[:, 0] > n[:, 0]
            if more.any():
                data = pa.array([_packed(k[more], all_of_it[more])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), data], ["block", "data"])

    sent = blocks.select("block", "text").groupBy("block").applyInArrow(send, "shard int, block int, data binary")
    return sent.repartition(n_shards, "shard").select("block", "data").mapInArrow(merge, "block int, data binary")


def pseudo_likelihood(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(id, n_words, log_likelihood, mean_log_likelihood)``, a row per input row.

    A null or empty text has no words, a sum of 0 and a null mean; a null id
    stays null; repeated rows are scored each.
    """
    docs = W.bounded(docs)
    classes = word_classes(docs, text_col, bits)
    network = train(docs, classes, text_col, bits)
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    n_blocks = -(-n_bytes // block_bytes) or 1
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _zipped(batch.column(2))], ["id", "block", "text"])

    # The id as well, so that copies of a text go to different blocks.
    rows = rows.select("id", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int").alias("block"), "text")
    zipped_schema = T.StructType([rows.schema["id"], rows.schema["block"], T.StructField("text", T.BinaryType())])
    blocks = rows.mapInArrow(zipped, zipped_schema)

    def run(part: pa.Table, counted: pa.Table) -> pa.Table:
        # Shards come in any order.
        found = sorted((_unpacked(x) for x in counted.column("data").to_pylist()), key=lambda x: x[0][0])
        known = tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else None
        n_words, value = score_block(_unzipped(part.column("text")), classes, network, known, bits)
        mean = pa.array(value / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.table(
            [part.column("id"), pa.array(n_words.astype(np.int64)), pa.array(value), mean], names=names
        )

    names = [id_col, "n_words", "log_likelihood", "mean_log_likelihood"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name, kind in zip(names[1:], ("long", "double", "double"), strict=True):
        schema.add(name, kind)
    counted = _corpus_counts(blocks, n_blocks)
    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(run, schema)
