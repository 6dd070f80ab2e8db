"""Whole Arrow text columns as flat numpy arrays: words, hashes and windows.

A word is a run of bytes other than space and the five ASCII control blanks.
Every function works on one bounded slice of rows at a time, so a task holds a
few megabytes of text whatever its partition holds.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 3 << 20
SLICE_ROWS = 4096

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LONG_SPAN = 256


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of few rows unless the session says otherwise: a row may be a long text."""
    spark = df.sparkSession
    if spark.conf.get(_BATCH_ROWS, None) is None:
        spark.conf.set(_BATCH_ROWS, "1000")
    return df


def release() -> None:
    """Hands memory that is free but held back by the allocators to the system: a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: int | str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut so that a piece has about ``limit`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = flat(batch.column(text))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            stop = min(max(stop, at + 1), at + SLICE_ROWS, batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop
    release()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def salt(seed: int) -> np.uint64:
    return np.uint64(seed * int(_M3) & ((1 << 64) - 1))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _M3 + right)


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each ``data[start : start + length]``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    out = mix(length.astype(np.uint64) + salt(seed) + np.uint64(1))
    out = combine(out, at[start] & _KEEP[np.minimum(length, 8)])
    rest = np.flatnonzero((length > 8) & (length <= _LONG_SPAN))
    done = 8
    while len(rest):
        part = at[start[rest] + done] & _KEEP[np.minimum(length[rest] - done, 8)]
        out[rest] = combine(out[rest], part)
        done += 8
        rest = rest[length[rest] > done]
    for i in np.flatnonzero(length > _LONG_SPAN):
        digest = hashlib.blake2b(data[start[i] : start[i] + length[i]].tobytes(), digest_size=8, salt=seed.to_bytes(4, "little"))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text starts, and the end
    start: np.ndarray  # of each word, in data
    length: np.ndarray  # of each word, in bytes
    first: np.ndarray  # the first word of each text, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_spans(self.data, self.start, self.length, seed)


def split(column: pa.Array, lower: bool = False) -> Words:
    """The words of each text; ``lower`` turns A-Z into a-z first."""
    data, offsets = flat(column)
    if lower:
        data = _LOWER[data]
    inside = ~_BLANK[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    heads = offsets[:-1][np.diff(offsets) > 0]
    opens[heads] = inside[heads]
    tails = heads[1:] - 1
    closes[tails] = inside[tails]
    start = np.flatnonzero(opens)
    length = np.flatnonzero(closes) + 1 - start
    return Words(data, offsets, start, length, np.searchsorted(start, offsets))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` hashes, in order; runs may cross texts."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out, built, power, width = None, 0, hashes, 1
    while True:
        if size & width:
            out = power if out is None else combine(out[: len(power) - built], power[built:])
            built += width
        if built == size:
            return out[: len(hashes) - size + 1]
        power, width = combine(power[:-width], power[width:]), width * 2


def whole(first: np.ndarray, size: int) -> np.ndarray:
    """Places of the windows of ``size`` words that lie within one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], counts)


def ranges(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each given length, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(start - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each part of ``values``; parts may be empty."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[first[1:]] - total[first[:-1]]


def texts_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
