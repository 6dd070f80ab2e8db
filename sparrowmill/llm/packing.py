"""Packing token ids into sequences of bounded length by multiway differencing.

Documents longer than a sequence first give whole sequences. What is left is
gathered into batches that hold exactly as many tokens as their windows, and a
batch is divided by Karmarkar-Karp differencing: the partial partitions with
the greatest imbalance are merged, the heaviest window of one onto the lightest
of the other. Near-equal windows then overflow by a few tokens at most, and that
overflow is cut off and moved to the windows with room.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words as W
from .token_ids import BYTE_BPE, encoder, with_end

CAPACITY = 2048
WINDOWS = 16  # in a batch
END = 1

# A piece of a document: (row in ``Packer.docs``, first id, length).
Piece = tuple[int, int, int]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """The places of ``sizes`` in ``k`` groups of near-equal sums."""
    if not sizes:
        return [[] for _ in range(k)]
    heap = []
    for i, size in enumerate(sizes):
        loads = [(size, [i]), *[(0, [])] * (k - 1)]  # heaviest first
        heap.append((-size, i, loads))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        loads = [(a + b, x + y) for (a, x), (b, y) in zip(one, reversed(two), strict=True)]
        loads.sort(key=lambda load: -load[0])
        least = loads[-1][0]
        if least:  # only the differences matter
            loads = [(a - least, x) for a, x in loads]
        heapq.heappush(heap, (-loads[0][0], tie, loads))
    return [items for _, items in heap[0][2]]


def divide(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Groups of whole pieces, none above ``capacity``; the window count rises until that holds.

    A size above ``capacity`` is an error.
    """
    if any(s > capacity for s in sizes):
        raise ValueError("a piece is larger than the capacity")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, k)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return groups
        k += 1


def fill(pieces: list[Piece], k: int, capacity: int = CAPACITY) -> list[list[Piece]]:
    """Exactly ``k`` full windows of pieces that hold ``k * capacity`` tokens together.

    Overflow left by the differencing is cut off and moved to where there is room.
    """
    groups = [[pieces[i] for i in g] for g in differencing([p[2] for p in pieces], k)]
    spare: list[Piece] = []
    for group in groups:
        over = sum(p[2] for p in group) - capacity
        while over > 0:
            doc, start, length = group.pop()
            take = min(over, length)
            if take < length:
                group.append((doc, start, length - take))
            spare.append((doc, start + length - take, take))
            over -= take
    for group in groups:
        room = capacity - sum(p[2] for p in group)
        while room > 0:
            doc, start, length = spare.pop()
            take = min(room, length)
            group.append((doc, start, take))
            if take < length:
                spare.append((doc, start + take, length - take))
            room -= take
    return groups


class Packer:
    """Takes documents one by one and gives the sequences that are full."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS):
        self.capacity, self.windows = capacity, windows
        self.waiting: list[Piece] = []
        self.total = 0

    def add(self, doc: int, length: int) -> Iterator[list[Piece]]:
        whole = length - length % self.capacity
        for start in range(0, whole, self.capacity):
            yield [(doc, start, self.capacity)]
        rest = length - whole
        if not rest:
            return
        room = self.windows * self.capacity - self.total
        take = min(rest, room)
        self.waiting.append((doc, whole, take))
        self.total += take
        if take == room:
            yield from fill(self.waiting, self.windows, self.capacity)
            self.waiting, self.total = [], 0
            if take < rest:
                self.waiting.append((doc, whole + take, rest - take))
                self.total = rest - take

    def finish(self) -> Iterator[list[Piece]]:
        """The rest as full windows, and then in lengths that are powers of two, which need no padding."""
        full, tail = divmod(self.total, self.capacity)
        cut: list[Piece] = []
        while tail > sum(p[2] for p in cut):
            doc, start, length = self.waiting.pop()
            take = min(length, tail - sum(p[2] for p in cut))
            cut.append((doc, start + length - take, take))
            if take < length:
                self.waiting.append((doc, start, length - take))
        if full:
            yield from fill(self.waiting, full, self.capacity)
        power = 1 << max(tail.bit_length() - 1, 0)
        while tail:
            if tail & power:
                room, window = power, []
                while room:
                    doc, start, length = cut.pop()
                    take = min(room, length)
                    window.append((doc, start, take))
                    if take < length:
                        cut.append((doc, start + take, length - take))
                    room -= take
                yield window
                tail -= power
            power >>= 1
        self.waiting, self.total = [], 0


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    windows: int = WINDOWS,
    tokenizer: str = BYTE_BPE,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """A row per piece: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Every id of every document lies in exactly one piece. All sequences are full
    but for at most ``log2(capacity)`` of each task, whose lengths are powers of
    two (``capacity`` must be one). A null or empty text is its end id alone; a
    null id stays null; repeated rows are packed each. ``keep_ids`` adds the ids.

    Each task packs the rows of its partition as they stream by, without a
    shuffle, and holds one batch of windows. The high bits of ``sequence_id``
    are the number of the task's partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, codec = Packer(capacity, windows), encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        waiting: dict[int, tuple] = {}  # documents with pieces not yet given out
        n_docs = 0
        rows: list[tuple] = []

        def put(windows_done) -> None:
            nonlocal sequence
            for window in windows_done:
                offset = 0
                for doc, start, length in window:
                    key, ids = waiting[doc]
                    part = ids[start : start + length].astype("<u4").tobytes()
                    rows.append((key, start, length, zlib.crc32(part), len(ids), sequence, offset, part))
                    offset += length
                sequence += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if keep_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        key_type = None
        for part in W.slices(batches, 1):
            key_type = part.schema.field(0).type
            ids, first = with_end(*codec.encode(part.column(1)), end)
            for i, key in enumerate(part.column(0).to_pylist()):
                waiting[n_docs] = (key, ids[first[i] : first[i + 1]])
                put(packer.add(n_docs, int(first[i + 1] - first[i])))
                n_docs += 1
            still = {p[0] for p in packer.waiting}
            waiting = {doc: (key, ids.copy()) for doc, (key, ids) in waiting.items() if doc in still}
            if rows:
                yield out()
        put(packer.finish())
        if rows:
            yield out()

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name in names[1:]:
        schema.add(name, "long")
    if keep_ids:
        names.append("ids")
        schema.add("ids", T.ArrayType(T.IntegerType()))
    return W.bounded(docs).select(id_col, text_col).mapInArrow(run, schema)
