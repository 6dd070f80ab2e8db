"""Substring dedup: passages whose word sequence also starts elsewhere are cut out of each text.

Every window of ``size`` words has an anchor, the run of ``ANCHOR`` words in it
with the least hash, so equal windows share their anchor and its place in them.
Anchors found at one place only cannot belong to a repeated window. Around the
others the words are cut out as segments, and a shard takes all segments of its
anchors. A shard indexes its segments (suffix array, Burrows-Wheeler transform,
a wavelet tree for the ranks) and streams them through backward search: a run
whose interval holds two suffixes or more occurs twice. Long runs are tried
first, since all windows in a repeated run are repeated.

The word at which the anchor begins is marked in its segment. Segments overlap,
and the mark keeps one place of a text from matching itself: it has one mark in
each of its segments, while equal windows at two places have the same one.

Copies of a whole text are one text to the index, and copies of one segment are
one segment; a window in either is repeated without a search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import BROADCAST_BYTES, sized_join
from ..session import cut_lineage
from . import words as W

SIZE = 35
ANCHOR = 8
SHARD_SEGMENTS = 3072  # about as many places has a shard
HOT_SEGMENTS = 16_384  # an anchor at more places is resolved window by window
FILTER_WORDS = 1 << 20  # of 64 bits
_MARK = np.uint64(1 << 32)  # on the code of the word at which the anchor begins


# --- the index -------------------------------------------------------------


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``codes``, by doubling the length that is sorted."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        if rank[order[-1]] == n - 1 or width >= n:
            return order
        width *= 2


class WaveletTree:
    """Counts of a symbol before a place of a sequence, a level for every four bits of the alphabet.

    At each level the symbols stand stably sorted by their higher digits, and
    running counts of the sixteen digits lead to the next level.
    """

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        n = len(symbols)
        digits = max(1, -(-int(n_symbols - 1).bit_length() // 4))
        self.shifts = [4 * k for k in range(digits - 1, -1, -1)]
        self.next: list[np.ndarray] = []  # of each level: by digit and place, the place on the next level
        now = symbols
        for shift in self.shifts:
            digit = (now >> shift) & 15
            table = np.zeros((16, n + 1), np.int32)
            for d in range(16):
                np.cumsum(digit == d, out=table[d, 1:], dtype=np.int32)
            table[1:] += np.cumsum(table[:-1, -1])[:, None].astype(np.int32)
            self.next.append(table.ravel())
            now = now[np.argsort(digit.astype(np.uint8), kind="stable")]
        # Equal symbols now stand together.
        head = np.flatnonzero(np.append(True, now[1:] != now[:-1]))
        self.starts = np.zeros(n_symbols, np.int32)
        self.starts[now[head]] = head
        self.row = n + 1

    def rank(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before two places."""
        for shift, table in zip(self.shifts, self.next, strict=True):
            row = ((symbols >> shift) & 15) * self.row
            low, high = table[row + low], table[row + high]
        start = self.starts[symbols]
        return low - start, high - start


class FMIndex:
    """Backward search over segments of word codes."""

    def __init__(self, segments: list[np.ndarray]):
        lengths = np.array([len(s) for s in segments])
        words = np.concatenate(segments)
        kinds, codes = np.unique(words, return_inverse=True)
        self.n_separators = len(segments)
        # Each segment ends in a separator of its own, smaller than any word.
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.text = np.empty(self.first[-1], np.int64)
        ends = self.first[1:] - 1
        inner = np.ones(len(self.text), dtype=bool)
        inner[ends] = False
        self.text[inner] = codes + self.n_separators
        self.text[ends] = np.arange(self.n_separators)
        order = suffix_array(self.text)
        n_symbols = self.n_separators + len(kinds)
        before = self.text[order - 1]
        # Words alone are searched for, so separators share one symbol of the transform.
        self.tree = WaveletTree(np.maximum(before - self.n_separators + 1, 0), len(kinds) + 1)
        smaller = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=n_symbols))])
        self.smaller = smaller[self.n_separators :].astype(np.int32)

    def repeated(self, ends: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` words that end before each place occur twice or more in the index."""
        found = np.ones(len(ends), dtype=bool)
        live = np.arange(len(ends))
        low = np.zeros(len(ends), np.int32)
        high = np.full(len(ends), len(self.text), np.int32)
        for step in range(1, length + 1):
            symbol = self.text[ends[live] - step] - self.n_separators
            base = self.smaller[symbol]
            low, high = self.tree.rank(symbol + 1, low, high)
            low, high = base + low, base + high
            more = high - low >= 2
            if not more.all():
                found[live[~more]] = False
                live, low, high = live[more], low[more], high[more]
            if not len(live):
                break
        return found

    def windows(self, size: int, asked: np.ndarray | None = None) -> np.ndarray:
        """Of each segment: a bit for each window of ``size`` words that occurs twice or more, the first the lowest.

        Segments that are not ``asked`` for are in the index but get no bits.
        """
        counts = np.maximum(np.diff(self.first) - size, 0)  # a segment's windows; its separator is in none
        if asked is not None:
            counts = np.where(asked, counts, 0)
        starts = W.ranges(self.first[:-1], counts)
        of = np.repeat(np.arange(len(counts)), counts)
        place = starts - self.first[of]
        result = np.zeros(len(starts), dtype=bool)
        # A repeated run of more words settles several windows at once.
        for step in (size * 2 // 5, size // 5):
            if step > 1:
                lead = np.flatnonzero(~result & (place % step == 0) & (place + step <= counts[of]))
                good = lead[self.repeated(starts[lead] + size + step - 1, size + step - 1)]
                for k in range(step):
                    result[good + k] = True
        rest = np.flatnonzero(~result)
        result[rest] = self.repeated(starts[rest] + size, size)
        return W.sums(result.astype(np.int64) << place, np.concatenate([[0], np.cumsum(counts)]))


# --- anchors and segments --------------------------------------------------


def _signature(hashes: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits for the word sequence of each text; None without words."""
    counts = np.diff(first)
    place = W.ranges(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
    out = []
    for seed in (1, 2):
        out.append(W.sums(W.mix(W.combine(hashes, place) + W.salt(seed)), first))
    pair = np.column_stack(out).astype("<u8")
    return [row.tobytes() if n else None for row, n in zip(pair, counts, strict=True)]


def anchors(hashes: np.ndarray, first: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, keys)``: the anchor of each window of ``size`` words, each place once."""
    group = W.whole(first, size)
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys = W.windows(hashes, anchor)
    span = size - anchor + 1  # anchors of a window
    # Least hash in every run of ``span``; of equal ones the first, which is at the same place in equal windows.
    place = np.arange(len(keys))
    value, where, built = keys, place, 1
    while built < span:
        step = min(built, span - built)
        left, right = value[:-step], value[step:]
        pick = right < left
        value = np.where(pick, right, left)
        where = np.where(pick, where[step:], where[:-step])
        built += step
    chosen = np.unique(where[group])
    return chosen, keys[chosen]


def _bit_filter(shared: DataFrame) -> np.ndarray:
    """Eight megabytes of bits, in which every shared anchor has one. It holds back most others; a join follows."""
    word = F.expr(f"shiftright(anchor, 6) & {FILTER_WORDS - 1}").alias("word")
    bit = F.expr("shiftleft(1L, CAST(anchor & 63 AS INT))")
    rows = shared.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _segments(
    docs: DataFrame, text_col: str, size: int, anchor: int, give: list[str], bits: np.ndarray
) -> DataFrame:
    """The columns ``give`` of the anchors of every text that pass the filter ``bits``.

    ``place`` is a number for the place in the distinct word sequence ``seq``,
    ``pos`` the anchor's first word, ``kind`` 128 bits of the segment and its
    mark, ``before`` and ``n_words`` the words before the anchor in the segment
    and in all, ``segment`` the codes of its words.
    """
    reach = size - anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 0, limit=2 << 20):
            words = W.split(part.column(0))
            hashes = words.hashes()
            at, keys = anchors(hashes, words.first, size, anchor)
            word = bits[(keys >> np.uint64(6)) & np.uint64(FILTER_WORDS - 1)]
            passed = (word >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)
            at, keys = at[passed], keys[passed]
            if not len(at):
                continue
            text = np.searchsorted(words.first, at, side="right") - 1
            signature = _signature(hashes, words.first)
            pos = at - words.first[text]
            made = {"anchor": pa.array(keys.view(np.int64))}
            if "place" in give:
                head = np.frombuffer(b"".join(x or bytes(16) for x in signature), "<u8")[::2]
                made["place"] = pa.array(W.combine(head[text], pos.astype(np.uint64)).view(np.int64))
            if "kind" in give:
                low = np.maximum(at - reach, words.first[text])
                high = np.minimum(at + anchor + reach, words.first[text + 1])
                codes = (hashes >> np.uint64(32)).astype("<u4").tobytes()
                cut = [codes[4 * a : 4 * b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                before = (at - low).astype(np.int32)
                made["before"] = pa.array(before)
                made["n_words"] = pa.array((high - low).astype(np.int32))
                made["kind"] = pa.array(
                    [
                        hashlib.blake2b(x, digest_size=16, salt=b.to_bytes(4, "little")).digest()
                        for x, b in zip(cut, before.tolist(), strict=True)
                    ]
                )
                made["segment"] = pa.array(cut, pa.binary())
            if "seq" in give:
                made["seq"] = pa.array([signature[t] for t in text.tolist()], pa.binary())
                made["pos"] = pa.array(pos.astype(np.int32))
            yield pa.RecordBatch.from_arrays([made[x] for x in give], give)

    kinds = {
        "anchor": "long", "place": "long", "kind": "binary", "before": "int", "n_words": "int", "segment": "binary",
        "seq": "binary", "pos": "int",
    }
    return docs.select(text_col).mapInArrow(run, ", ".join(f"{x} {kinds[x]}" for x in give))


def _search(segments: DataFrame, shards: int, size: int) -> DataFrame:
    """``(kind, copied, windows, places)``: of each distinct segment, a bit for each repeated window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            # The only kind of its anchor has nothing to match.
            _, of, kinds = np.unique(rows.column(1).to_numpy(), return_inverse=True, return_counts=True)
            indexed = np.flatnonzero(kinds[of] > 1)
            copied = rows.column(3).to_numpy(zero_copy_only=False)
            marks = np.zeros(rows.num_rows, np.int64)
            if len(indexed):
                some = rows.take(pa.array(indexed))
                parts = []
                for x, before in zip(some.column(5).to_pylist(), some.column(4).to_pylist(), strict=True):
                    codes = np.frombuffer(x, "<u4").astype(np.uint64)
                    codes[before] |= _MARK
                    parts.append(codes)
                marks[indexed] = FMIndex(parts).windows(size, ~copied[indexed])
            columns = [rows.column(2), rows.column(3), pa.array(marks), rows.column(6)]
            return pa.RecordBatch.from_arrays(columns, ["kind", "copied", "windows", "places"])

        for batch in batches:
            shard_of = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard_of[1:] != shard_of[:-1]) + 1).tolist(), len(shard_of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if shard is not None and shard_of[a] != shard:
                    yield flush()
                    held = []
                shard = shard_of[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()
        W.release()

    return (
        segments.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "kind", "copied", "before", "segment", "places")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(run, "kind binary, copied boolean, windows long, places long")
    )


def _by_window(segments: DataFrame, size: int) -> DataFrame:
    """The same for anchors at very many places.

    Equal windows are gathered by their words and their mark, added up before
    they travel, so no task holds an anchor. What is alone has nothing to match.
    """
    n_windows = (F.octet_length("segment") / 4 - size + 1).cast("int")
    words = F.expr(f"substring(segment, at * 4 + 1, {4 * size})")
    mark = F.expr("CAST(CAST(before - at AS STRING) AS BINARY)")
    each = (
        segments.where(n_windows > 0)
        .withColumn("at", F.explode(F.sequence(F.lit(0), n_windows - 1)))
        # 128 bits of the words and the place of the mark.
        .select("kind", "at", F.unhex(F.md5(F.concat(words, mark))).alias("window"))
    )
    of = F.xxhash64("kind")
    many = cut_lineage(
        each.groupBy("window").agg(F.min(of).alias("one"), F.max(of).alias("two")).where("one != two").select("window")
    )
    if many.count() * 48 <= BROADCAST_BYTES:
        many = F.broadcast(many)
    hit = each.join(many, "window", "left_semi")
    found = hit.groupBy("kind").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("windows"))
    return segments.select("kind", "copied", "places").join(found, "kind", "left").select(
        "kind", "copied", F.coalesce("windows", F.lit(0).cast("long")).alias("windows"), "places"
    )


def _counted(docs: DataFrame, text_col: str, size: int, anchor: int) -> DataFrame:
    """``(anchor, text, one, two, weight)``: the anchors at two places or more, and, with ``text`` the
    word sequence and anchor 0, the texts of ``size`` words or more that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 0, limit=2 << 20):
            words = W.split(part.column(0))
            hashes = words.hashes()
            at, keys = anchors(hashes, words.first, size, anchor)
            if not len(at):
                continue
            text = np.searchsorted(words.first, at, side="right") - 1
            signature = _signature(hashes, words.first)
            head = np.frombuffer(b"".join(x or bytes(16) for x in signature), "<u8")[::2]
            place = W.combine(head[text], (at - words.first[text]).astype(np.uint64)).view(np.int64)
            long = [x for x, n in zip(signature, words.counts.tolist(), strict=True) if n >= size]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([keys.view(np.int64), np.zeros(len(long), np.int64)])),
                    pa.array([None] * len(at) + long, pa.binary()),
                    pa.array(np.concatenate([place, np.zeros(len(long), np.int64)])),
                ],
                ["anchor", "text", "place"],
            )

    return cut_lineage(
        docs.select(text_col)
        .mapInArrow(run, "anchor long, text binary, place long")
        .groupBy("anchor", "text")
        .agg(F.min("place").alias("one"), F.max("place").alias("two"), F.count(F.lit(1)).alias("weight"))
        .where("one != two OR (text IS NOT NULL AND weight > 1)")
    )


def repeated_places(
    docs: DataFrame, counted: DataFrame, text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR
) -> DataFrame:
    """``(seq, runs)``: where repeated windows start in each distinct word sequence that has some.

    ``seq`` is 128 bits of the word sequence. Copies of whole texts do not count
    here. ``runs`` is an array of ``(start, windows)``, a word place and a bit
    for each window from there on.
    """
    shared = counted.where("text IS NULL AND one != two").select("anchor", "weight")
    n_shared, n_places, n_hot = shared.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0)), F.count(F.when(F.col("weight") > HOT_SEGMENTS, 1))
    ).first()

    bits = _bit_filter(shared)

    def of_shared(give: list[str]) -> DataFrame:
        rows = _segments(docs, text_col, size, anchor, ["anchor", *give], bits)
        return sized_join(rows, shared, n_shared * 24, "anchor", "weight", [give[0]])

    kinds = (
        of_shared(["kind", "before", "segment", "place"])
        .groupBy("anchor", "weight", "kind", "before", "segment")
        .agg(F.min("place").alias("one"), F.max("place").alias("two"), F.count(F.lit(1)).alias("places"))
        .select("anchor", "weight", "kind", "before", "segment", F.expr("one != two").alias("copied"), "places")
    )
    if n_hot:
        kinds = cut_lineage(kinds)  # read twice
    shards = max(1, -(-n_places // SHARD_SEGMENTS))
    found = _search(kinds.where(F.col("weight") <= HOT_SEGMENTS) if n_hot else kinds, shards, size)
    if n_hot:
        found = found.unionByName(_by_window(kinds.where(F.col("weight") > HOT_SEGMENTS), size))
    found = cut_lineage(found.where("copied OR windows != 0"))
    n_found = found.count()
    rows = of_shared(["seq", "pos", "kind", "before", "n_words"]).select("seq", "pos", "kind", "before", "n_words").distinct()
    hits = sized_join(rows, found, n_found * 72, "kind", "places", ["seq", "pos"])  # a passage may stand in very many texts
    every = F.expr(f"shiftleft(1L, greatest(n_words - {size - 1}, 0)) - 1")
    run = F.struct((F.col("pos") - F.col("before")).alias("start"), F.when(F.col("copied"), every).otherwise(F.col("windows")).alias("windows"))
    # A text's anchors: some for every hundred of its own words.
    return hits.select("seq", run.alias("run")).where("run.windows != 0").groupBy("seq").agg(F.collect_list("run").alias("runs"))


def _with_sequence(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__seq`` and ``__n_words``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, at):
            words = W.split(part.column(at))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(_signature(words.hashes(), words.first), pa.binary()), pa.array(words.counts.astype(np.int64))],
                names,
            )

    names = [*docs.columns, "__seq", "__n_words"]
    schema = T.StructType([*docs.schema.fields]).add("__seq", "binary").add("__n_words", "long")
    return docs.mapInArrow(run, schema)


def removals(docs: DataFrame, text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """The rows of ``docs`` with ``__runs``, the places of repeated windows, and ``__weight``, above 1 if the
    whole word sequence occurs in other rows too (then every window is repeated)."""
    if not 1 <= size - anchor + 1 <= 63:
        raise ValueError("size must exceed anchor by 62 at most")
    docs = W.bounded(docs)
    counted = _counted(docs, text_col, size, anchor)
    places = repeated_places(docs, counted, text_col, size, anchor)
    rows = _with_sequence(docs, text_col)
    copies = counted.where("text IS NOT NULL").select(F.col("text").alias("seq"), "weight")
    marks = cut_lineage(
        copies.join(places, "seq", "full_outer").select(
            F.col("seq").alias("__seq"), F.coalesce("weight", F.lit(1)).alias("__weight"), F.col("runs").alias("__runs")
        )
    )
    n_bytes = marks.agg(F.coalesce(F.sum(F.coalesce(F.size("__runs"), F.lit(0)) * 16 + 64), F.lit(0))).first()[0]
    spread = [c for c, kind in docs.dtypes if kind in ("bigint", "int", "string")] or ["__n_words"]
    return sized_join(rows, marks, n_bytes, "__seq", "__weight", spread, "left")


def _cut(text: bytes, runs: list[dict] | None, copied: bool, size: int) -> tuple[int, bytes]:
    """``(words removed, kept words joined by one blank)``"""
    words = text.split()
    if copied and len(words) >= size:
        return len(words), b""
    if not runs:
        return 0, b" ".join(words)
    start = np.array([r["start"] for r in runs], np.int64)
    bits = np.array([r["windows"] for r in runs], np.int64)
    run, shift = np.nonzero(bits[:, None] >> np.arange(63) & 1)
    at = start[run] + shift
    edge = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + size, minlength=len(words) + 1)
    covered = np.cumsum(edge[:-1]) > 0
    return int(covered.sum()), b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone])


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR
) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)``, a row per input row.

    Windows are judged on the input. A null, empty or short text keeps all its
    words; a null id stays null; repeated rows are copies of each other.
    """
    marked = removals(docs.select(id_col, text_col), text_col, size, anchor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 1):
            runs, weight = part.column(3).to_pylist(), part.column(4).to_pylist()
            cut = [_cut(t, s, (w or 1) > 1, size) for t, s, w in zip(W.texts_of(part.column(1)), runs, weight, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), pa.array([c[0] for c in cut], pa.int64()),
                    pa.array([hashlib.sha256(c[1]).hexdigest() for c in cut], pa.string()),
                ],
                [id_col, "n_words", "n_removed", "kept_sha256"],
            )

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    return marked.select(id_col, text_col, "__n_words", "__runs", "__weight").mapInArrow(run, schema)


def kept_texts(docs: DataFrame, text_col: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with the kept words as text. Rows from which nothing is removed stay as they are."""
    marked = removals(docs, text_col, size, anchor)
    names = docs.columns
    at, columns = names.index(text_col), [*names, "__runs", "__weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, at):
            runs, weight = part.column(len(columns) - 2).to_pylist(), part.column(len(columns) - 1).to_pylist()
            texts = []
            for text, s, w in zip(part.column(at).to_pylist(), runs, weight, strict=True):
                removed, kept = _cut((text or "").encode(), s, (w or 1) > 1, size)
                texts.append(kept.decode() if removed else text)
            new = [*part.columns[:at], pa.array(texts, part.schema.field(at).type), *part.columns[at + 1 : -2]]
            yield pa.RecordBatch.from_arrays(new, names)

    return marked.select(*columns).mapInArrow(run, docs.schema)
