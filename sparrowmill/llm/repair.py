"""Token-id files compressed by a grammar that replaces frequent pairs.

A block holds consecutive documents. Their ids are compressed by Re-Pair:
frequent pairs of neighbours become nonterminals, again and again, never across
the end of a document, until no pair is frequent. The block stores the rules, the
length each one expands to, and how many ids each document has, all in as many
bits as their largest needs, so that any range of ids is decoded by expanding
only the symbols that overlap it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import BROADCAST_BYTES
from ..session import scratch_path
from . import words as W
from .token_ids import BYTE_BPE, encoder, with_end

END = 0
BLOCK_TOKENS = 1 << 20
LEAST_COUNT = 8  # a pair found less often stays
LEAST_USES = 3  # a rule is two symbols and a length; fewer places would not pay for it
SWEEPS = 2

_MAGIC = b"RPG2"
_HEAD = struct.Struct("<4sIIIIQ")  # magic, terminals, documents, rules, symbols, ids
_CROWD = 1 << 15
_SPREAD, _SLOT_SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
_PACKED = 1 << 16  # numbers packed at a time; of eight or a multiple, every width ends on a byte


@dataclass
class Grammar:
    base: int  # ids below are terminals; rule r is symbol base + r
    left: np.ndarray
    right: np.ndarray
    symbols: np.ndarray

    def lengths(self) -> np.ndarray:
        """How many ids each rule stands for. A rule refers to earlier symbols only."""
        out = np.ones(self.base + len(self.left), np.int64)
        for low, high in self._levels():
            at = slice(low, high)
            out[self.base + low : self.base + high] = out[self.left[at]] + out[self.right[at]]
        return out

    def _levels(self) -> Iterator[tuple[int, int]]:
        """Runs of rules that refer only to symbols before the run."""
        newest, low = np.maximum(self.left, self.right).astype(np.int64) - self.base, 0
        while low < len(newest):
            later = np.flatnonzero(newest[low:] >= low)
            high = low + int(later[0]) if len(later) else len(newest)
            yield low, high
            low = high


def compress(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int | None = None) -> Grammar:
    """``ids`` as a grammar; no symbol reaches past a place in ``ends`` (one after each document).

    A round counts the pairs that may be frequent and replaces them all, the more
    frequent first where two overlap. A pair that was not frequent never becomes
    so later, hence only what was left over and what stands beside a new symbol
    is counted again. Without ``rounds`` it goes on until no pair is frequent.
    """
    symbols, n = ids.astype(np.uint32), len(ids)
    after = np.arange(1, n + 1, dtype=np.int32)  # the next symbol that is left, of each
    before = np.arange(-1, n, dtype=np.int32)
    left = np.ones(n, dtype=bool)
    last = np.zeros(n, dtype=bool)  # the symbol is the last of its document
    last[ends[ends > 0] - 1] = True
    last[-1:] = True
    weight = np.zeros(n + 2, np.int32)
    lefts, rights, n_rules = [], [], 0
    at = np.flatnonzero(~last).astype(np.int32)
    while len(at) and rounds != 0:
        keys = symbols[at].astype(np.uint64) << np.uint64(32) | symbols[after[at]]
        if len(at) > _CROWD:  # a pair in a slot of few is not frequent
            slots = (keys * _SPREAD >> _SLOT_SHIFT).astype(np.int64)
            some = np.bincount(slots)[slots] >= LEAST_COUNT
            at, keys = at[some], keys[some]
        kinds = pa.array(keys).dictionary_encode()
        codes, kinds = kinds.indices.to_numpy(), kinds.dictionary.to_numpy()
        counts = np.bincount(codes)
        frequent = np.flatnonzero(counts >= LEAST_COUNT)
        priority = np.zeros(len(counts), np.int32)
        priority[frequent[np.argsort(-counts[frequent], kind="stable")]] = np.arange(len(frequent), 0, -1)
        rank = priority[codes]
        at, codes, rank = at[rank > 0], codes[rank > 0], rank[rank > 0]
        chosen, of_kind = _apart(at, codes, rank, before, after, weight)
        enough = np.bincount(of_kind, minlength=len(counts)) >= LEAST_USES
        chosen, of_kind = chosen[enough[of_kind]], of_kind[enough[of_kind]]
        if not len(chosen):
            break
        number = np.cumsum(enough) - 1
        lefts.append((kinds[enough] >> np.uint64(32)).astype(np.uint32))
        rights.append((kinds[enough] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        symbols[chosen] = base + n_rules + number[of_kind]
        n_rules += len(lefts[-1])
        gone = after[chosen]
        last[chosen] = last[gone]
        after[chosen] = after[gone]
        before[after[gone]] = chosen
        left[gone] = False
        again = np.zeros(n, dtype=bool)
        again[at] = True
        again[chosen] = True
        again[before[chosen[before[chosen] >= 0]]] = True
        at = np.flatnonzero(again & left & ~last).astype(np.int32)
        rounds = None if rounds is None else rounds - 1
    empty = np.zeros(0, np.uint32)
    return Grammar(base, np.concatenate([empty, *lefts]), np.concatenate([empty, *rights]), symbols[left])


def _apart(
    at: np.ndarray, kind: np.ndarray, rank: np.ndarray, before: np.ndarray, after: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places, out of the ascending ``at``, of pairs that share no symbol, with the kind of each.

    A pair gives way to one of higher ``rank`` that overlaps it. In a run of one
    symbol every other pair is taken. A second sweep takes what the first one's
    choices leave free. ``weight`` has zeros, before and after.
    """
    again = np.flatnonzero(kind[1:] == kind[:-1]) + 1
    again = again[at[again] == after[at[again - 1]]]  # the same pair, a symbol further
    if len(again):
        heads = np.append(True, again[1:] != again[:-1] + 1)
        nth = np.arange(len(again)) - np.maximum.accumulate(np.where(heads, np.arange(len(again)), 0))
        even = np.ones(len(at), dtype=bool)
        even[again[nth % 2 == 0]] = False
        at, kind, rank = at[even], kind[even], rank[even]
    low, high = before[at], after[at]  # the first has -1 before it, which is a weight that stays zero
    weight[at] = rank
    taken = np.zeros(len(at), dtype=bool)
    for _ in range(SWEEPS):
        inner = weight[at]
        now = (inner > weight[low]) & (inner > weight[high])
        taken |= now
        for spot in (low[now], at[now], high[now]):
            weight[spot] = 0
    weight[at] = 0
    return at[taken], kind[taken]


def expand(grammar: Grammar, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for; ``lengths`` as ``grammar.lengths()`` gives them."""
    ends = np.cumsum(lengths[symbols])
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    at = ends - lengths[symbols]
    while len(symbols):
        rules = symbols >= grammar.base
        out[at[~rules]] = symbols[~rules]
        rule, at = symbols[rules] - grammar.base, at[rules]
        left = grammar.left[rule]
        symbols, at = np.concatenate([left, grammar.right[rule]]), np.concatenate([at, at + lengths[left]])
    return out


def packed(values: np.ndarray) -> bytes:
    """A byte that tells the width, then the numbers in as many bits each."""
    width = max(int(values.max(initial=0)).bit_length(), 1)
    parts = [bytes([width])]
    for k in range(0, len(values), _PACKED):
        octets = np.ascontiguousarray(values[k : k + _PACKED], "<u4").view(np.uint8).reshape(-1, 4)
        parts.append(np.packbits(np.unpackbits(octets, axis=1, count=width, bitorder="little"), bitorder="little").tobytes())
    return b"".join(parts)


def unpacked(payload: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The ``n`` numbers packed at ``at`` of ``payload``, and where they end."""
    width, at = payload[at], at + 1
    out = np.empty(n, np.uint32)
    for k in range(0, n, _PACKED):
        m = min(_PACKED, n - k)
        octets = np.frombuffer(payload, np.uint8, (m * width + 7) // 8, at)
        bits = np.unpackbits(octets, count=m * width, bitorder="little").reshape(m, width)
        wide = np.zeros((m, 32), np.uint8)
        wide[:, :width] = bits
        out[k : k + m] = np.packbits(wide, axis=1, bitorder="little").view("<u4")[:, 0]
        at += len(octets)
    return out, at


def write_block(ids: np.ndarray, first: np.ndarray, base: int, rounds: int | None = None) -> bytes:
    """The block of documents whose ids begin at ``first`` (and the end)."""
    grammar = compress(ids, first[1:], base, rounds)
    of_rule = grammar.lengths()[base:]
    head = _HEAD.pack(_MAGIC, base, len(first) - 1, len(grammar.left), len(grammar.symbols), len(ids))
    arrays = (grammar.left, grammar.right, of_rule, np.diff(first), grammar.symbols)
    return head + b"".join(packed(a) for a in arrays)


class Block:
    """A written block, read by document or by any range of ids."""

    def __init__(self, payload: bytes):
        magic, base, n_docs, n_rules, n_symbols, self.n_ids = _HEAD.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a block of token ids")
        at, arrays = _HEAD.size, []
        for n in (n_rules, n_rules, n_rules, n_docs, n_symbols):
            values, at = unpacked(payload, at, n)
            arrays.append(values)
        left, right, of_rule, counts, symbols = arrays
        self.grammar = Grammar(base, left, right, symbols)
        self.first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.lengths = np.concatenate([np.ones(base, np.int64), of_rule])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths[symbols])])  # of each symbol, in ids
        if self.starts[-1] != self.n_ids or self.first[-1] != self.n_ids:
            raise ValueError("the block's lengths do not agree")

    def read(self, start: int, stop: int) -> np.ndarray:
        low = int(np.searchsorted(self.starts, start, side="right")) - 1
        high = int(np.searchsorted(self.starts, stop))
        ids = expand(self.grammar, self.grammar.symbols[low:high], self.lengths)
        return ids[start - self.starts[low] :][: stop - start]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.first[i]), int(self.first[i + 1]))


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = BYTE_BPE,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
    rounds: int | None = None,
) -> None:
    """Writes the blocks of ``docs`` under ``path``, in ascending order of id.

    A row of the written table is a block: ``(part, block, ids, n_tokens,
    payload)``. Documents are range-partitioned on the id, so ``part`` and then
    ``block`` put the blocks in order. Null ids come first; rows of one id stand
    in the order of their texts; a null or empty text is its end id alone. Files
    go through Spark's committed writer, which any shared store takes and which
    a lost executor cannot leave half done.
    """
    key_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part_id = encoder(tokenizer), TaskContext.get().partitionId()
        base = codec.tokenizer.get_vocab_size()
        keys, pieces, counts, total, block = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, pieces, counts, total, block
            first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            payload = write_block(np.concatenate(pieces), first, base, rounds=rounds)
            row = [
                pa.array([part_id], pa.int32()), pa.array([block], pa.int32()),
                pa.array([pa.array(keys, arrow_key).to_pylist()], pa.list_(arrow_key)),
                pa.array([total], pa.int64()), pa.array([payload], pa.binary()),
            ]
            keys, pieces, counts, total, block = [], [], [], 0, block + 1
            return pa.RecordBatch.from_arrays(row, ["part", "block", "ids", "n_tokens", "payload"])

        for rows in W.slices(batches, 1, limit=2 << 20):
            arrow_key = rows.schema.field(0).type
            ids, first = with_end(*codec.encode(rows.column(1)), end)
            keys += rows.column(0).to_pylist()
            pieces.append(ids)
            counts += np.diff(first).tolist()
            total += len(ids)
            if total >= block_tokens:
                yield flush()
        if keys:
            yield flush()

    schema = (
        T.StructType()
        .add("part", "integer")
        .add("block", "integer")
        .add("ids", T.ArrayType(key_type))
        .add("n_tokens", "long")
        .add("payload", "binary")
    )
    (
        W.bounded(docs).select(id_col, text_col)
        .repartitionByRange(F.col(id_col).asc_nulls_first())
        .sortWithinPartitions(F.col(id_col).asc_nulls_first(), text_col)
        .mapInArrow(run, schema)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_ids(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of each document, from written blocks.

    ``start`` counts the ids of all documents before it: those of the parts
    before, a row each, and of the blocks before in its part.
    """
    sizes = blocks.select("part", "block", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_parts = (
        sizes.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    )
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(of_parts, "part").select(
        "part", "block", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).alias("block_start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                begin = batch.column(0)[i].as_py()
                keys = batch.column(1).slice(i, 1).flatten()
                block = Block(batch.column(2)[i].as_py())
                raw = memoryview(block.read(0, block.n_ids).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(block.first[:-1].tolist(), block.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(begin + block.first[:-1]), pa.array(np.diff(block.first)), pa.array(crc, pa.int64())],
                    [id_col, "start", "n_tokens", "ids_crc32"],
                )

    schema = T.StructType([T.StructField(id_col, blocks.schema["ids"].dataType.elementType)])
    for name in ("start", "n_tokens", "ids_crc32"):
        schema.add(name, "long")
    if sizes.count() * 64 <= BROADCAST_BYTES:  # a small row for each block of a million ids
        starts = F.broadcast(starts)
    return blocks.join(starts, ["part", "block"]).select("block_start", "ids", "payload").mapInArrow(run, schema)


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Writes ``docs`` as token-id blocks in the shared folder and reads them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_ids(docs, path, id_col, text_col, **how)
    return read_ids(spark.read.parquet(path), id_col)
