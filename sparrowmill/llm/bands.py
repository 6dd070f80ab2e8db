"""Quality rules from compression: zstandard ratios held against bands by length.

Repetitive text compresses far better than prose, and noise far worse. A whole
text is compressed at once, and again in fixed chunks, so that a repetitive or
random stretch inside a long text shows as well. Short texts compress less, so
the limits depend on the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W

CHUNK_BYTES = 4096
MIN_WORDS = 50
LEVEL = 3

# (bytes up to, least ratio, greatest ratio); the last holds for everything longer.
# Words of random letters reach 1.53 at 512 bytes, 1.63 at 1 kB, 1.66 at 1.5 kB, 1.72 at 8 kB and 1.73 beyond; the
# least of sf0.1 is 1.34 up to 384 bytes, 1.41 to 512, 1.43 to 768, 1.57 to 1 kB, 1.69 to 1.5 kB, 1.84 to 2 kB, 1.92 to
# 8 kB and 2.21 beyond. Up to 1 kB the two overlap, and the limits keep out only noise of more symbols than 26.
BANDS = (
    (128, 0.0, 4.0), (256, 1.05, 3.0), (384, 1.25, 2.6), (512, 1.3, 2.6), (768, 1.35, 2.6), (1024, 1.5, 2.6),
    (1536, 1.67, 2.8), (2048, 1.75, 2.8), (8192, 1.8, 3.0), (1 << 62, 2.0, 3.5),
)
# The greatest share of chunks outside the band of their own length.
BAD_CHUNKS = 0.1

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_FIELDS = [
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
    ("n_repeat_words", "long"), ("base_failed", "boolean"), ("whole_ratio", "double"),
    ("bad_chunk_share", "double"), ("kept", "boolean"),
]


def _limits(n_bytes: int) -> tuple[float, float]:
    return next((low, high) for top, low, high in BANDS if n_bytes <= top)


def ratio(packer: zstandard.ZstdCompressor, text: bytes) -> float:
    return len(text) / len(packer.compress(text)) if text else 0.0


def verdict(packer: zstandard.ZstdCompressor, text: bytes) -> tuple[float, float, bool]:
    """``(whole ratio, share of bad chunks, kept)`` of one text."""

    def outside(part: bytes, value: float) -> bool:
        low, high = _limits(len(part))
        return not low <= value <= high

    value = ratio(packer, text)
    if len(text) <= CHUNK_BYTES:
        bad = float(outside(text, value))
        return value, bad, not bad
    # The last chunk takes the rest with it, so that every chunk is a full one.
    cuts = [*range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES), len(text)]
    parts = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    bad = sum(outside(p, ratio(packer, p)) for p in parts) / len(parts)
    return value, bad, not outside(text, value) and bad <= BAD_CHUNKS


def _repeated_words(words: W.Words) -> np.ndarray:
    """Per text, the words in three-word windows found twice or more in it."""
    n_texts = len(words.first) - 1
    place = W.whole(words.first, 3)
    if not len(place):
        return np.zeros(n_texts, np.int64)
    grams = W.windows(words.hashes(), 3)[place]
    keys = W.combine(grams, words.text_of[place].astype(np.uint64))
    codes = pa.array(keys).dictionary_encode()
    codes = codes.indices.to_numpy()
    repeated = place[np.bincount(codes)[codes] > 1]
    covered = np.zeros(len(words.start) + 2, dtype=np.int64)
    for shift in range(3):
        covered[repeated + shift] = 1
    return W.sums(covered[: len(words.start)], words.first)


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of ``_FIELDS`` for a slice of texts."""
    words = W.split(texts)
    data, offsets = words.data, words.offsets
    lead = ((data & 0xC0) != 0x80) & ~W._BLANK[data]
    raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    packer = zstandard.ZstdCompressor(level=LEVEL)
    verdicts = [verdict(packer, x) for x in raw]
    n_words, n_repeat = words.counts.astype(np.int64), _repeated_words(words)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
    return {
        "n_words": n_words,
        "word_chars": W.sums(lead.astype(np.int64), offsets),
        "n_symbols": W.sums(_SYMBOL[data].astype(np.int64), offsets),
        "n_dup_lines": np.array([_duplicate_lines(x) for x in raw], dtype=np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "whole_ratio": np.array([v[0] for v in verdicts], dtype=np.float64),
        "bad_chunk_share": np.array([v[1] for v in verdicts], dtype=np.float64),
        "kept": ~failed & np.array([v[2] for v in verdicts], dtype=bool),
    }


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, measures, base_failed, whole_ratio, bad_chunk_share, kept)``, a row per input row.

    A null or empty text has no words, fails the base rule and is not kept. A
    null id stays null; repeated rows are judged each. Other columns are not
    read. There is no shuffle: every text is judged by itself.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 1):
            found = measure(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, found.values())], [id_col, *found])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name, kind in _FIELDS:
        schema.add(name, kind)
    return W.bounded(docs).select(id_col, text_col).mapInArrow(judge, schema)


def kept_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text passes ``quality_rules``."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, at):
            yield part.filter(pa.array(measure(part.column(at))["kept"]))

    return W.bounded(docs).mapInArrow(keep, docs.schema)
