"""Substring dedup by suffix arrays: bytes of strings that also start elsewhere are removed.

Every string of ``size`` bytes has an anchor, the run of ``ANCHOR`` bytes in it
with the least hash, so equal strings have their anchor at the same place. The
starts that share one place's anchor are neighbours; they and the bytes they
reach are a segment. Anchors found at one place only are left out. A shard has
all segments of its anchors; it sorts their suffixes by external induced sorting
and reads repeated strings off the common prefixes: neighbours in the order that
share ``size`` bytes. Each start of a text lies in one segment only, so a place
never matches itself.

Equal segments are one before they travel, with a note that there are several.
Texts are told apart by 128-bit digests; copies of a whole text are one text,
and removed altogether. An anchor at very many places is dealt over shards by
the distance between start and anchor, which equal strings have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import salted_join
from ..session import cut_lineage
from . import induced_sort as I
from . import words as W

SIZE = 200
ANCHOR = 32
BLOCK = 1 << 20  # bytes whose anchors are looked for together
SHARD_PLACES = 1 << 15  # about as many segments has a shard, before equal ones are one
HOT_PLACES = 1 << 13  # an anchor at more places is dealt by distance
STRIDE = 8  # distances that stay together then
FILTER_BITS = 26

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_PLACE_BITS = np.uint64(28)


# --- anchors ---------------------------------------------------------------


class _Grams:
    """Hashes of the runs of ``size`` bytes that start at each byte of a block: polynomials over 64 bits."""

    def __init__(self, size: int):
        self.size = size
        self.of_byte = W.mix(np.arange(1, 257, dtype=np.uint64))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) < n:
            steps = np.full(n, _ROOT)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _INVERSE
            self.down = np.cumprod(steps, dtype=np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.up[:n], out=total[1:])
        return (total[self.size :] - total[: n + 1 - self.size]) * self.down[: n + 1 - self.size]


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` neighbours: of blocks of ``span``, the least so far and the least to come."""
    n = len(values)
    padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, span)
    so_far = np.minimum.accumulate(blocks, axis=1).ravel()
    to_come = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_come[: n - span + 1], so_far[span - 1 : n])


def segments(data: np.ndarray, offsets: np.ndarray, grams: _Grams, size: int) -> tuple[np.ndarray, ...]:
    """``(keys, places, first, last)``: each anchor's hash and place, and the first and last of the starts that it serves."""
    found = []
    span = size - grams.size + 1
    for low in range(0, max(len(data) - size + 1, 0), BLOCK):
        part = data[low : low + BLOCK + size - 1]
        if len(part) < size:
            break
        hashes = grams(part)
        order = (hashes * _ROOT) >> _PLACE_BITS << _PLACE_BITS | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(order, span) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        # Starts whose string lies within one text.
        text = np.searchsorted(offsets, low, side="right") - 1
        stop = np.searchsorted(offsets, low + len(part), side="left")
        begin = np.maximum(offsets[text:stop] - low, 0)
        end = np.minimum(offsets[text + 1 : stop + 1] - low, len(part)) - size + 1
        starts = W.ranges(begin, np.maximum(end - begin, 0))
        if not len(starts):
            continue
        own = at[starts]
        new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)))
        last = np.append(new[1:], len(starts)) - 1
        anchor = own[new]
        found.append((W.mix(hashes[anchor]), anchor + low, starts[new] + low, starts[last] + low))
    if not found:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate([x[i] for x in found]) for i in range(4))


def _dealt(keys, places, first, last, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(route, of, first, last)``: the starts of hot anchors apart by their distance from the anchor."""
    near, far = (places - last) // STRIDE, (places - first) // STRIDE
    near, far = np.where(hot, near, 0), np.where(hot, far, 0)
    of = np.repeat(np.arange(len(keys)), far - near + 1)
    group = W.ranges(near, far - near + 1)
    split = hot[of]
    first = np.where(split, np.maximum(first[of], places[of] - (group * STRIDE + STRIDE - 1)), first[of])
    last = np.where(split, np.minimum(last[of], places[of] - group * STRIDE), last[of])
    route = np.where(split, W.combine(keys[of], group.astype(np.uint64) + np.uint64(1)), keys[of])
    return route, of, first, last


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bits(keys: DataFrame, column: str) -> np.ndarray:
    """Eight megabytes of bits, in which every key has one; it holds back most others."""
    word = F.expr(f"shiftright({column} & {(1 << FILTER_BITS) - 1}, 6)").alias("word")
    bit = F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))")
    rows = keys.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


# --- a shard ---------------------------------------------------------------


def repeated_starts(parts: list[bytes], weights: np.ndarray, size: int, memory: int = I.MEMORY) -> np.ndarray:
    """Whether the string at each start of each part, one after the other, is there twice or more; a part counts ``weights`` times."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1)
    disk = I.Disk(memory)
    text = disk.array(int(ends[-1]) + 1, np.uint8)
    # Bytes of UTF-8 stay below 246; 1 parts the segments and 0 ends the text.
    joined = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    np.add(joined, 2, out=text[:-1])
    first = ends - lengths - 1
    counts = np.maximum(lengths - size + 1, 0)
    own = disk.array(len(text), np.uint8)
    starts = W.ranges(first, counts)
    own[starts] = np.repeat(weights, counts)
    hit = disk.array(len(text), bool)
    carried = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def settle(places: np.ndarray, shared: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray]:
        """Marks the runs of equal strings; the last one is handed back, as it may go on."""
        head = np.flatnonzero(np.append(True, shared[1:] < size))
        keep = len(places) if final else int(head[-1])
        if keep:
            head = head[head < keep]
            total = np.add.reduceat(own[places[:keep]].astype(np.int64), head)
            several = np.repeat(total > 1, np.diff(np.append(head, keep)))
            hit[places[:keep][several]] = True
        return places[keep:], shared[keep:]

    for places, shared in I.suffixes(text, 256, disk, size):
        carried = settle(np.append(carried[0], places), np.append(carried[1], shared), False)
    settle(*carried, True)
    disk.close()
    return hit[starts]


def _search(kinds: DataFrame, shards: int, size: int) -> DataFrame:
    """``(kind, head, starts, n)``: of each segment with repeated strings, a bit for each start; null if it occurs several times itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            route = np.unique(rows.column("route").to_numpy(), return_inverse=True)[1]
            copied = rows.column("copied").to_numpy()
            # Nothing is to be found out where a route has one segment, or all of its segments are copies.
            useful = (np.bincount(route) > 1) & (np.bincount(route, ~copied) > 0)
            some = np.flatnonzero(useful[route])
            bits: dict[int, bytes] = {}
            parts = rows.column("segment").to_pylist()
            if len(some):
                chosen = [parts[i] for i in some.tolist()]
                hit = repeated_starts(chosen, copied[some].astype(np.uint8) + 1, size)
                at = 0
                for i, part in zip(some.tolist(), chosen, strict=True):
                    n = len(part) - size + 1
                    mine = hit[at : at + n]
                    at += n
                    if mine.any():
                        bits[i] = np.packbits(mine).tobytes()
            out = [i for i in range(len(parts)) if copied[i] or i in bits]
            kinds = [hashlib.md5(parts[i]).digest() for i in out]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds, pa.binary()),
                    pa.array(np.frombuffer(b"".join(kinds), "<i8")[::2]),
                    pa.array([None if copied[i] else bits[i] for i in out], pa.binary()),
                    rows.column("n").take(pa.array(out, pa.int64())).combine_chunks(),
                ],
                ["kind", "head", "starts", "n"],
            )

        for batch in batches:
            shard_of = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard_of[1:] != shard_of[:-1]) + 1).tolist(), len(shard_of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and shard_of[a] != shard:
                    yield flush()
                    held = []
                shard = shard_of[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()
        W.release()

    return (
        kinds.select(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"), "route", "copied", "n", "segment")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(run, "kind binary, head long, starts binary, n long")
    )


# --- on Spark --------------------------------------------------------------


def _digests(column: pa.Array) -> list[bytes]:
    return [hashlib.md5(x).digest() for x in W.texts_of(column)]


def _counted(docs: DataFrame, text_col: str, size: int, anchor: int) -> DataFrame:
    """``(anchor, text, one, two, n)``: the anchors at two places or more, and, with anchor 0, the digests
    of the texts of ``size`` bytes or more that are there twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(anchor)
        for part in W.slices(batches, 0):
            data, offsets = W.flat(part.column(0))
            keys, places, _, _ = segments(data, offsets, grams, size)
            digests = _digests(part.column(0))
            text = np.searchsorted(offsets, places, side="right") - 1
            head = np.frombuffer(b"".join(digests), "<u8")[::2]
            place = W.combine(head[text], (places - offsets[text]).astype(np.uint64)).view(np.int64)
            long = [d for d, n in zip(digests, np.diff(offsets).tolist(), strict=True) if n >= size]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([keys.view(np.int64), np.zeros(len(long), np.int64)])),
                    pa.array([None] * len(keys) + long, pa.binary()),
                    pa.array(np.concatenate([place, np.zeros(len(long), np.int64)])),
                ],
                ["anchor", "text", "place"],
            )

    return cut_lineage(
        docs.select(text_col).mapInArrow(run, "anchor long, text binary, place long")
        .groupBy("anchor", "text")
        .agg(F.min("place").alias("one"), F.max("place").alias("two"), F.count(F.lit(1)).alias("n"))
        .where("one != two OR (text IS NOT NULL AND n > 1)")
    )


def _placed(
    docs: DataFrame, text_col: str, size: int, anchor: int, shared: np.ndarray, hot: np.ndarray, found: np.ndarray | None
) -> DataFrame:
    """The segments of anchors in ``shared``, dealt where in ``hot``: ``(anchor, route, place, segment)``,
    or with ``found``, a filter of kinds, ``(kind, text, start, many)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(anchor)
        for part in W.slices(batches, 0, limit=2 << 20):
            data, offsets = W.flat(part.column(0))
            keys, places, first, last = segments(data, offsets, grams, size)
            some = _passes(shared, keys)
            keys, places, first, last = keys[some], places[some], first[some], last[some]
            if not len(keys):
                continue
            route, of, first, last = _dealt(keys, places, first, last, _passes(hot, keys))
            whole = data.tobytes()
            cut = [whole[a : b + size] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            text = np.searchsorted(offsets, first, side="right") - 1
            digests = _digests(part.column(0))
            if found is None:
                head = np.frombuffer(b"".join(digests), "<u8")[::2]
                place = W.combine(head[text], (first - offsets[text]).astype(np.uint64))
                arrays = [pa.array(x.view(np.int64)) for x in (keys[of], route, place)] + [pa.array(cut, pa.binary())]
            else:
                kinds = b"".join(hashlib.md5(x).digest() for x in cut)
                good = np.flatnonzero(_passes(found, np.frombuffer(kinds, "<u8")[::2]))
                arrays = [
                    pa.array([kinds[16 * i : 16 * i + 16] for i in good.tolist()], pa.binary()),
                    pa.array([digests[t] for t in text[good].tolist()], pa.binary()),
                    pa.array((first - offsets[text])[good]),
                    pa.array((last - first + 1)[good]),
                ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["anchor", "route", "place", "segment"] if found is None else ["kind", "text", "start", "many"]
    schema = "anchor long, route long, place long, segment binary"
    if found is not None:
        schema = "kind binary, text binary, start long, many long"
    return docs.select(text_col).mapInArrow(run, schema)


def repeated_strings(docs: DataFrame, counted: DataFrame, text_col: str, size: int, anchor: int) -> DataFrame:
    """``(text, runs)``: where repeated strings start in each distinct text (its digest) that has some.

    ``runs`` is an array of ``(start, many, starts)``: a byte place and a bit for
    each of the ``many`` starts from there on; null if all are repeated.
    """
    shared = counted.where("text IS NULL").select("anchor", "n")
    n_shared, n_places = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    filters = _bits(shared, "anchor"), _bits(shared.where(F.col("n") > HOT_PLACES), "anchor")
    rows = _placed(docs, text_col, size, anchor, *filters, None)
    if n_shared * 8 > 1 << FILTER_BITS:  # the filter lets many others pass
        rows = salted_join(rows, shared, "anchor", "n", ["place"])
    kinds = (
        rows.groupBy("route", "segment")
        .agg(F.min("place").alias("one"), F.max("place").alias("two"), F.count(F.lit(1)).alias("n"))
        .select("route", "segment", F.expr("one != two").alias("copied"), "n")
    )
    found = cut_lineage(_search(kinds, max(1, -(-n_places // SHARD_PLACES)), size))
    places = _placed(docs, text_col, size, anchor, *filters, _bits(found, "head")).distinct()
    hits = salted_join(places, found.select("kind", "starts", "n"), "kind", "n", ["text", "start"])
    # A text's segments: one or two for every hundred of its own bytes.
    return hits.groupBy("text").agg(F.collect_list(F.struct("start", "many", "starts")).alias("runs"))


def marked(docs: DataFrame, text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """The rows of ``docs`` with ``__runs``, the places of repeated strings, and ``__copies``, above 1 if other
    rows have the same text (then every string of it is repeated)."""
    if not 1 <= anchor <= size:
        raise ValueError("anchor must be from 1 to size")
    docs = W.bounded(docs)
    counted = _counted(docs, text_col, size, anchor)
    runs = repeated_strings(docs, counted, text_col, size, anchor)
    copies = counted.where("text IS NOT NULL").select("text", "n")
    marks = cut_lineage(
        copies.join(runs, "text", "full_outer").select(
            F.col("text").alias("__text"), F.coalesce("n", F.lit(1)).alias("__copies"), F.col("runs").alias("__runs")
        )
    )
    rows = docs.withColumn("__text", F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    spread = [F.col(c) for c, kind in docs.dtypes if kind in ("bigint", "int", "string")]
    # Copies of one text are told apart by their other columns, and rows alike in all of them by their place.
    rows = rows.withColumn("__spread", F.xxhash64(*spread, F.monotonically_increasing_id()))
    return salted_join(rows, marks, "__text", "__copies", ["__spread"], "left").drop("__text", "__spread")


def removed(n: int, runs: list[dict] | None, copied: bool, size: int) -> np.ndarray:
    """Whether each of ``n`` bytes of a text is covered by a repeated string."""
    if copied and n >= size:
        return np.ones(n, bool)
    edge = np.zeros(n + 1, np.int64)
    for run in runs or ():
        start, many = run["start"], run["many"]
        at = np.arange(start, start + many)
        if run["starts"] is not None:
            at = at[np.unpackbits(np.frombuffer(run["starts"], np.uint8), count=many).astype(bool)]
        np.add.at(edge, at, 1)
        np.subtract.at(edge, at + size, 1)
    return np.cumsum(edge[:-1]) > 0


def _cut(text: bytes, runs: list[dict] | None, copies: int | None, size: int) -> tuple[bytes, int, int]:
    """``(kept bytes, bytes removed, removed runs)``"""
    if not runs and (copies or 1) < 2:
        return text, 0, 0
    gone = removed(len(text), runs, (copies or 1) > 1, size)
    spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)``, a row per input row.

    Strings are judged on the input, as UTF-8 bytes, and never go on from one
    text to another. A null or empty text, and one of fewer than ``size`` bytes,
    keeps all it has; a null id stays null; repeated rows are copies of each
    other; an empty table gives no rows. Other columns are ignored.
    """
    rows = marked(docs.select(id_col, text_col), text_col, size, anchor).select(id_col, text_col, "__runs", "__copies")
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 1):
            texts, runs, copies = W.texts_of(part.column(1)), part.column(2).to_pylist(), part.column(3).to_pylist()
            cut = [_cut(t, r, n, size) for t, r, n in zip(texts, runs, copies, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64()),
                    pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string()),
                ],
                names,
            )

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    return rows.mapInArrow(run, schema)


def kept_texts(docs: DataFrame, text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the kept bytes as text, cut characters left out. Rows without repeated strings stay as they are."""
    rows = marked(docs, text_col, size, anchor).select(*docs.columns, "__runs", "__copies")
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, at):
            runs, copies = part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist()
            texts = part.column(at).to_pylist()
            for i, (text, r, n) in enumerate(zip(list(texts), runs, copies, strict=True)):
                kept, gone, _ = _cut((text or "").encode(), r, n, size)
                if gone:
                    texts[i] = kept.decode(errors="ignore")
            new = [*part.columns[:at], pa.array(texts, part.schema.field(at).type), *part.columns[at + 1 : len(names)]]
            yield pa.RecordBatch.from_arrays(new, names)

    return rows.mapInArrow(run, docs.schema)
