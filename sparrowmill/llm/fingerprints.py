"""Document fingerprints: the least probable byte windows, in chained Bloom filters.

Every window of 64 bytes has an entropy. How often each level of entropy occurs
over all documents ranks the windows: the rarer its level, the better a window
tells documents apart. A window that has the best rank among its neighbours
again and again is a feature. A text without such a window has the hashes of all
its shorter windows instead, or of itself. Features go into Bloom filters of 2048 bits, 160
to a filter, and two chains of filters are compared by the overlap of their
bits above what chance would give.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

WINDOW = 64
NEIGHBOURS = 32
POPULAR = 12  # neighbourhoods that a feature must win
LEVELS = 512
BITS = 2048
PER_FILTER = 160
HASHES = 5
SHORT = 8  # bytes of a window of a text without features
LEAST = 64  # features that such a text has
FEW = 16  # a last filter with fewer features is not compared if there is another
_LANE = 512
# c log2 c in whole numbers, so that sums do not depend on their order.
_SCALE = 1 << 20
_LOG = np.rint(np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1)) * _SCALE).astype(np.int32)


def window_levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of the 64-byte window at each place of ``data``.

    Byte counts are carried along many stretches of the data at once.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    lanes = -(-n // _LANE)
    padded = np.concatenate([data, np.zeros(lanes * _LANE + WINDOW - len(data), np.uint8)])
    # Column j holds byte j of every lane, window tail included.
    view = np.lib.stride_tricks.as_strided(padded, (_LANE + WINDOW, lanes), (1, _LANE))
    steps = np.ascontiguousarray(view).astype(np.int32) + np.arange(lanes, dtype=np.int32) * 256
    counts = np.zeros(lanes * 256, np.int8)
    gain = np.diff(_LOG)  # of the sum of c log c, from count c to c + 1
    total = np.zeros(lanes, np.int32)
    out = np.empty((_LANE, lanes), np.int32)
    for j in range(_LANE + WINDOW - 1):
        new = steps[j]
        have = counts[new]
        total += gain[have]
        counts[new] = have + 1
        if j >= WINDOW - 1:
            out[j - WINDOW + 1] = total
            old = steps[j - WINDOW + 1]
            left = counts[old] - 1
            counts[old] = left
            total -= gain[left]
    entropy = np.log2(WINDOW) - out.T.reshape(-1)[:n] / (WINDOW * _SCALE)  # 0 to 6 bits
    return np.clip(np.rint(entropy * ((LEVELS - 1) / np.log2(WINDOW))), 0, LEVELS - 1).astype(np.int16)


def _places(offsets: np.ndarray, size: int) -> np.ndarray:
    return W.whole(offsets, size)


def level_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank of each entropy level by how rarely it occurs in all documents; 0 is the rarest.

    One small row per level and task is shuffled, ``LEVELS`` rows reach the driver.
    Levels that never occur, and those of runs of a few bytes, rank last.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for part in W.slices(batches, 0):
            data, offsets = W.flat(part.column(0))
            place = _places(offsets, WINDOW)
            if len(place):
                total += np.bincount(window_levels(data)[place], minlength=LEVELS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["level", "n"])

    rows = docs.select(text_col).mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(LEVELS, np.int64)
    for r in rows:
        seen[r.level] = r.n
    weak = (seen == 0) | (np.arange(LEVELS) < LEVELS // 6)
    order = np.lexsort((np.arange(LEVELS), seen, weak))
    ranks = np.empty(LEVELS, np.int64)
    ranks[order] = np.arange(LEVELS)
    return ranks


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, texts)`` of the selected windows, in order."""
    levels = window_levels(data)
    group = _places(offsets, WINDOW + NEIGHBOURS - 1)
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The first of the best windows in each neighbourhood.
    best = ranks[levels] << 40 | np.arange(len(levels))
    width = 1
    while width < NEIGHBOURS:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    winner = best[group] & ((1 << 40) - 1)
    # A text's winners do not decrease, and texts follow each other, so equal ones are neighbours.
    head = np.flatnonzero(np.append(True, winner[1:] != winner[:-1]))
    won = np.diff(np.append(head, len(winner)))
    place = winner[head][won >= POPULAR]
    return place, np.searchsorted(offsets, place, side="right") - 1


def _short_features(data: np.ndarray) -> np.ndarray:
    size = min(SHORT, len(data))
    place = np.arange(len(data) - size + 1)
    found = np.unique(W.hash_spans(data, place, np.full(len(place), size)))[:PER_FILTER]
    # A few bits would be met by chance in a full filter: few windows count several times, under other hashes.
    return np.concatenate([found, *(W.combine(found, np.full(len(found), k, np.uint64)) for k in range(1, -(-LEAST // len(found))))])


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text: an array of bits with a row per filter, and its feature counts.

    A text without features, for being short or uniform, has its windows of
    ``SHORT`` bytes, at most ``PER_FILTER`` of them, those of the least hashes; a shorter
    one is a feature itself. Only an empty text has no filter.
    """
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    place, text = features(data, offsets, ranks)
    hashes = W.hash_spans(data, place, np.full(len(place), WINDOW))
    bare = np.flatnonzero((np.bincount(text, minlength=len(texts)) == 0) & (np.diff(offsets) > 0))
    if len(bare):
        more = [_short_features(data[offsets[i] : offsets[i + 1]]) for i in bare]
        hashes = np.concatenate([hashes, *more])
        text = np.concatenate([text, np.repeat(bare, [len(m) for m in more])])
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    if not len(text):
        return [np.zeros((0, BITS), np.uint8) for _ in texts]
    # Equal windows of a text count once.
    key = W.combine(hashes, text.astype(np.uint64))
    once = np.sort(np.unique(key, return_index=True)[1])
    hashes, text = hashes[once], text[once]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    n_filters = -(-np.diff(first) // PER_FILTER)
    filter_first = np.concatenate([[0], np.cumsum(n_filters)])
    filter_of = filter_first[text] + (np.arange(len(text)) - first[text]) // PER_FILTER
    bits = np.zeros((filter_first[-1], BITS), np.uint8)
    for k in range(HASHES):
        bits[filter_of, (hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)] = 1
    return [bits[a:b] for a, b in zip(filter_first[:-1], filter_first[1:], strict=True)]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """How alike two chains are, 0 to 1: each filter of the shorter against its best match in the other.

    The overlap of two filters counts from what independent bits would share to
    the most they could. Two chains without filters, of empty texts, are alike,
    one without is unlike any other.
    """
    if len(one) > len(two):
        one, two = two, one
    if not len(one):
        return float(not len(two))
    if one.shape == two.shape and np.array_equal(one, two):
        return 1.0
    one, two = _full(one), _full(two)
    if len(one) > len(two):
        one, two = two, one
    size_one, size_two = one.sum(1, dtype=np.float64), two.sum(1, dtype=np.float64)
    shared = one.astype(np.float32) @ two.T.astype(np.float32)
    most = np.minimum(size_one[:, None], size_two)
    chance = size_one[:, None] * size_two / BITS
    value = (shared - chance) / np.maximum(most - chance, 1e-9)
    return float(np.clip(value, 0, 1).max(1).mean())


def _full(chain: np.ndarray) -> np.ndarray:
    if len(chain) > 1 and chain[-1].sum() < FEW * HASHES * 0.8:
        return chain[:-1]
    return chain


def encoded(chain: np.ndarray) -> str:
    return base64.b64encode(np.packbits(chain, axis=1).tobytes()).decode()


def _ordered(docs: DataFrame, id_col: str, text_col: str, per_part: int) -> DataFrame:
    """``(part, follower, id, text)`` by descending id within parts that each end with the next part's first row.

    Part bounds are quantiles of the ids, so parts have like numbers of rows; no
    part is gathered whole, they are sorted and streamed.
    """
    key = F.col(id_col).cast("long")
    n, least = docs.agg(F.count(F.lit(1)), F.min(key)).first()
    n_parts = max(1, n // per_part)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "key", F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63)))
    )
    if n_parts == 1:
        bounds = np.zeros(0, np.int64)
    else:
        shares = [i / n_parts for i in range(1, n_parts)]
        found = rows.agg(F.percentile_approx("key", shares, 100 * n_parts).alias("b")).first()[0]
        bounds = np.unique(np.array(found, np.int64))
    top = len(bounds)

    @F.pandas_udf("int")
    def part_of(keys):
        import pandas as pd

        # Part 0 has the highest ids.
        return pd.Series((top - np.searchsorted(bounds, keys.to_numpy())).astype(np.int32))

    rows = rows.withColumn("part", part_of("key"))
    # The first row of each part closes the part before, and that of the first one the last.
    heads = (
        rows.groupBy("part")
        .agg(F.max(F.struct("key", F.xxhash64("text").alias("tie"))).alias("head"))
        .select("part", F.col("head.key").alias("head_key"), F.col("head.tie").alias("head_tie"))
        .orderBy("part")
        .collect()
    )
    used = [h.part for h in heads]
    before = dict(zip(used, used[-1:] + used[:-1], strict=True))
    marks = docs.sparkSession.createDataFrame(
        [(h.part, h.head_key, h.head_tie, before[h.part]) for h in heads],
        "part int, head_key long, head_tie long, closes int",
    )
    closing = (
        rows.join(F.broadcast(marks), ["part"])
        .where("key = head_key AND xxhash64(text) = head_tie")
        .groupBy("closes")
        .agg(F.first("id").alias("id"), F.first("text").alias("text"), F.first("key").alias("key"))
        .select(F.col("closes").alias("part"), F.lit(1).alias("follower"), "id", "text", "key")
    )
    return (
        rows.select("part", F.lit(0).alias("follower"), "id", "text", "key")
        .unionByName(closing)
        .repartition("part")
        .sortWithinPartitions("part", "follower", F.desc("key"), F.desc(F.xxhash64("text")), F.desc("text"))
        .select("part", "follower", "id", "text")
    )


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many code points of the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_part: int = 2000
) -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    The next document is the one with the next lower id, after the lowest the
    highest; rows of one id stand in the order of a hash of their text, and null
    ids after all others. A single row follows itself. A null text is empty.
    Fingerprints are base64 strings of whole filters.
    """
    docs = W.bounded(docs)
    ranks = level_ranks(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last row so far, whose next one is still to come
        for part in W.slices(batches, 3, limit=2 << 20):
            parts, follows, keys, texts = (c.to_pylist() for c in part.columns)
            rows = list(zip(parts, follows, keys, texts, strict=True))
            if kept:
                rows = [kept, *rows]
            pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[1]]
            kept = rows[-1]
            if not pairs:
                continue
            raw = [r[3].encode() for r in rows]
            chains = fingerprints(raw, ranks)
            at = [i for i, r in enumerate(rows[:-1]) if not r[1]]
            edits = [edited_text(a[3], b[3]).encode() for a, b in pairs]
            edited = fingerprints(edits, ranks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], part.schema.field(2).type),
                    pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edits]),
                    pa.array([encoded(chains[i]) for i in at]),
                    pa.array([encoded(c) for c in edited]),
                    pa.array([likeness(chains[i], c) for i, c in zip(at, edited, strict=True)], pa.float64()),
                    pa.array([likeness(chains[i], chains[i + 1]) for i in at], pa.float64()),
                ],
                names,
            )

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name, kind in zip(names[1:], ("long", "string", "string", "string", "double", "double"), strict=True):
        schema.add(name, kind)
    return _ordered(docs, id_col, text_col, rows_per_part).mapInArrow(run, schema)
