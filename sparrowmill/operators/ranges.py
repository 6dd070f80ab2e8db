"""Sorted per-key lists from rows that are dealt out by the order of the lists, not by key.

A task has one range of that order, whatever the keys: its part of a key's list is a run,
and the list is the key's runs one after the other. Only runs travel by key, packed; where
in its list a run lies follows from the lengths of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows or tokens that a task tallies at a time; a list is packed anew for each of these.
AT_ONCE = 2_000_000
# Entries of one packed row.
RUN_ENTRIES = 4096
# Items of a key that one task puts together, and those of an output batch.
ITEMS_PER_TASK = 1_000_000
ITEMS_PER_BATCH = 200_000
ROWS_PER_BATCH = 20_000

_PACKED = [
    T.StructField("at", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("numbers", T.BinaryType()), T.StructField("names", T.BinaryType()),
]
_NUMBERS = 3  # of an entry: bytes of its name or -1, number, copies


def index_lists(corpus: DataFrame, tokens: Column, by: Column | str, by_record: bool, by_text: bool, size: int) -> DataFrame:
    """``(key, total, segment, items ARRAY<STRUCT<doc, tf>>)`` of ``(doc, line_no, line)`` for each token.

    ``by`` orders the documents. Lines travel once, to the task of their document's range.
    """
    unit = ["line_no"] if by_record else []
    in_order = corpus.select("doc", *unit, "line").repartitionByRange(by).sortWithinPartitions(by, *unit)
    dealt = in_order.select("doc", *unit, tokens.alias("tokens"))
    most = AT_ONCE  # as it is here, not in a worker
    items = T.StructType([T.StructField("doc", T.StringType()), T.StructField("tf", T.LongType())])
    return _lists(dealt, lambda batches: _tallied_lines(batches, by_record, by_text, most), items, size)


def target_lists(edges: DataFrame, distinct: bool, size: int) -> DataFrame:
    """``(key, total, segment, items ARRAY<STRING>)``: the sorted ``dst`` of each ``src``."""
    by = ["dst", "src"]  # so that a frequent target is dealt out too
    most = AT_ONCE
    # Edges of a target need no order, unless equal ones have to meet.
    dealt = edges.select(*by).repartitionByRange(*by).sortWithinPartitions(*(by if distinct else by[:1]))
    return _lists(dealt, lambda batches: _tallied_edges(batches, distinct, most), T.StringType(), size)


def _lists(dealt: DataFrame, tallied, item: T.DataType, size: int) -> DataFrame:
    """The lists of the entries that ``tallied`` makes, in order, of a task's rows."""
    run_entries, per_batch, width = RUN_ENTRIES, ITEMS_PER_BATCH, max(size, ITEMS_PER_TASK // size * size)
    key = T.StructField("key", T.StringType())
    runs = dealt.mapInArrow(lambda batches: _runs(tallied(batches), run_entries), T.StructType([key, *_PACKED]))
    of_key = Window.partitionBy("key")
    earlier = of_key.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.select(
        "*", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")).alias("start"),
        F.sum("n").over(of_key).alias("total"),
    )
    packed = ["key", "total", "stretch", "start", "numbers", "names"]
    kind = T.StructType([
        key, T.StructField("total", T.LongType()), T.StructField("segment", T.LongType()),
        T.StructField("items", T.ArrayType(item)),
    ])

    def cut(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(lambda batches: _segments(batches, size, width, item, per_batch), kind)

    light = placed.where(F.col("total") <= width).sortWithinPartitions("key", "start")
    # A longer list is cut into stretches, each put together by a task.
    touched = F.sequence(F.expr(f"start div {width}"), F.expr(f"(start + n - 1) div {width}"))
    heavy = (
        placed.where(F.col("total") > width).withColumn("stretch", F.explode(touched))
        .repartition("key", "stretch").sortWithinPartitions("key", "stretch", "start")
    )
    return cut(light.withColumn("stretch", F.lit(0).cast("bigint")).select(*packed)).unionByName(cut(heavy.select(*packed)))


# -- entries: (key, name, number, copies), in the lists' order for each key ----


def _codes(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values, nulls too, in the order they are met, and the place of each value among them."""
    coded = pc.dictionary_encode(values, null_encoding="encode")
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _text(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.string())


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of the weights of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(weights[order], first)


def _lines(batches: Iterable[pa.RecordBatch], by_record: bool, most: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Lines of about ``most`` tokens, and the number of each line's record among them; no record is split."""

    def numbered(table):
        if not by_record:
            return np.zeros(table.num_rows, np.int64)
        opens = np.zeros(table.num_rows, bool)
        for name in ("doc", "line_no"):
            codes = _codes(table.column(name).combine_chunks())[1]
            opens[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(opens)

    held, n_held = [], 0
    for batch in batches:
        held.append(batch)
        n_held += pc.sum(pc.list_value_length(batch.column("tokens"))).as_py() or 0
        if n_held < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        record = numbered(table)
        # The last record may go on.
        whole = int(np.searchsorted(record, record[-1])) if by_record else table.num_rows
        if whole:
            yield table.slice(0, whole), record[:whole]
            held = table.slice(whole).to_batches()
            n_held = pc.sum(pc.list_value_length(table.slice(whole).column("tokens"))).as_py() or 0
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def _tallied_lines(
    batches: Iterable[pa.RecordBatch], by_record: bool, by_text: bool, most: int
) -> Iterator[pa.Table]:
    """How often a token is in a document or, with ``by_record``, in how many of its lines how often."""
    # The entries of the last document so far.
    doc, terms = pa.array([], pa.string()), pa.array([], pa.string())
    tf = copies = np.zeros(0, np.int64)
    for lines, record in _lines(batches, by_record, most):
        tokens = lines.column("tokens").combine_chunks()
        words, line = _text(pc.list_flatten(tokens)), pc.list_parent_indices(tokens).to_numpy().astype(np.int64)
        n_open = len(terms)
        # Documents come in order, so their numbers are.
        docs, doc_of = _codes(pa.concat_arrays([doc, _text(lines.column("doc"))]))
        vocabulary, term = _codes(pa.concat_arrays([terms, words]))
        d = np.append(np.zeros(n_open, np.int64), doc_of[len(doc) :][line])
        if len(term) == 0:
            continue
        if by_record:
            in_record, n = _summed(record[line] * len(vocabulary) + term[n_open:], np.ones(len(words), np.int64))
            first_line = np.searchsorted(record, in_record // len(vocabulary))
            c = np.append(term[:n_open], in_record % len(vocabulary))
            d = np.append(d[:n_open], doc_of[len(doc) :][first_line])
            tfs, rank = np.unique(np.append(tf, n), return_inverse=True)
            if by_text:
                order = np.array(sorted(range(len(tfs)), key=lambda i: str(tfs[i])), np.int64)
                tfs, rank = tfs[order], np.argsort(order)[rank]
            key, copies = _summed((c * len(docs) + d) * len(tfs) + rank, np.append(copies, np.ones(len(n), np.int64)))
            key, tf = key // len(tfs), tfs[key % len(tfs)]
        else:
            key, tf = _summed(term * len(docs) + d, np.append(tf, np.ones(len(words), np.int64)))
            copies = np.ones(len(key), np.int64)
        c, d = key // len(docs), key % len(docs)
        last = d == len(docs) - 1
        yield _entries(vocabulary.take(pa.array(c[~last])), docs.take(pa.array(d[~last])), tf[~last], copies[~last])
        doc, terms, tf, copies = docs[-1:], vocabulary.take(pa.array(c[last])), tf[last], copies[last]
    yield _entries(terms, doc.take(pa.array(np.zeros(len(terms), np.int64))), tf, copies)


def _tallied_edges(batches: Iterable[pa.RecordBatch], distinct: bool, most: int) -> Iterator[pa.Table]:
    """Edges, with the number of equal ones."""
    held, n_held, last = [], 0, None

    def tallied():
        nonlocal last
        table = pa.Table.from_batches(held).combine_chunks()
        # Targets come in order, so their numbers are.
        (sources, s), (targets, d) = (_codes(_text(table.column(c))) for c in ("src", "dst"))
        key, copies = _summed(s * len(targets) + d, np.ones(len(s), np.int64))
        if distinct:
            copies[:] = 1
            # The last edge of the rows before may come once more.
            if last == (sources[0].as_py(), targets[0].as_py()):
                key, copies = key[1:], copies[1:]
            last = (sources[int(s[-1])].as_py(), targets[int(d[-1])].as_py())
        src, dst = sources.take(pa.array(key // len(targets))), targets.take(pa.array(key % len(targets)))
        return _entries(src, dst, np.zeros(len(key), np.int64), copies)

    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held >= most:
            yield tallied()
            held, n_held = [], 0
    if n_held:
        yield tallied()


def _entries(keys: pa.Array, names: pa.Array, numbers: np.ndarray, copies: np.ndarray) -> pa.Table:
    return pa.table({"key": keys, "name": names, "number": pa.array(numbers, pa.int64()), "copies": pa.array(copies, pa.int64())})


# -- runs and segments --------------------------------------------------------


def _slices(ends: np.ndarray, data) -> pa.Array:
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int32)), data or pa.py_buffer(b"")]
    )


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Where each value ends, with 0 in front, and the bytes of all."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = (data or pa.py_buffer(b""))[int(ends[0]) : int(ends[-1])]
    return ends - ends[0], data


def _runs(entries: Iterable[pa.Table], run_entries: int) -> Iterator[pa.RecordBatch]:
    """``(key, at, n, numbers, names)``: a key's entries, packed; ``at`` grows along its list."""
    at = TaskContext.get().partitionId() << 33
    for table in entries:
        if not table.num_rows:
            continue
        keys, code = _codes(_text(table.column("key")))
        order = np.argsort(code, kind="stable")
        code = code[order]
        opens = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        place = np.arange(len(code)) - np.repeat(opens, np.diff(np.append(opens, len(code))))
        cuts = np.flatnonzero(place % run_entries == 0)
        ends = np.append(cuts, len(code))
        names = _text(table.column("name")).take(pa.array(order))
        copies = table.column("copies").to_numpy()[order]
        lengths = pc.fill_null(pc.binary_length(names), -1).to_numpy()
        numbers = np.column_stack([lengths, table.column("number").to_numpy()[order], copies]).astype(np.int64)
        name_ends, name_bytes = _bytes_of(names)
        batch = pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(code[cuts])), pa.array(at + np.arange(len(cuts))), pa.array(np.add.reduceat(copies, cuts)),
                _slices(ends * 8 * _NUMBERS, pa.py_buffer(numbers)), _slices(name_ends[ends], name_bytes),
            ],
            ["key", *(f.name for f in _PACKED)],
        )
        at += len(cuts)
        for low in range(0, batch.num_rows, ROWS_PER_BATCH):
            yield batch.slice(low, ROWS_PER_BATCH)


def _segments(
    batches: Iterable[pa.RecordBatch], size: int, width: int, item: T.DataType, per_batch: int
) -> Iterator[pa.RecordBatch]:
    """``(key, total, segment, items)`` of runs that come in order, one segment after the other."""

    def listed(names, numbers):
        if isinstance(item, T.StructType):
            return pa.StructArray.from_arrays([names, pa.array(numbers)], item.names)
        return names

    def rows(key, total, segment, ends, names, numbers):
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), listed(names, numbers))
        return pa.RecordBatch.from_arrays(
            [key, pa.array(total, pa.int64()), pa.array(segment, pa.int64()), lists], ["key", "total", "segment", "items"]
        )

    # The segment that may go on: its key and number, and the parts that there are of it.
    open_as, open_row, parts = None, None, []

    def closed():
        names, numbers = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        return rows(*open_row, np.array([0, len(names)]), names, numbers)

    for batch in batches:
        key = batch.column(0)
        total, stretch, start = (batch.column(c).to_numpy() for c in (1, 2, 3))
        number_ends, number_bytes = _bytes_of(batch.column(4))
        numbers = np.frombuffer(number_bytes, np.int64).reshape(-1, _NUMBERS)
        lengths, number, copies = numbers[:, 0], numbers[:, 1], numbers[:, 2]
        row_of = np.repeat(np.arange(len(key)), np.diff(number_ends) // (8 * _NUMBERS))
        name_ends = np.append(0, np.cumsum(np.maximum(lengths, 0))).astype(np.int32)
        there = pa.array(lengths >= 0).buffers()[1]
        names = pa.StringArray.from_buffers(
            len(lengths), pa.py_buffer(name_ends), _bytes_of(batch.column(5))[1], there if (lengths < 0).any() else None
        )
        code = _codes(key)[1]
        stop = np.cumsum(copies)
        row_begins = np.append(0, stop)[number_ends[:-1] // (8 * _NUMBERS)]
        for low in range(0, int(stop[-1]), per_batch):
            at = np.arange(low, min(low + per_batch, int(stop[-1])))
            entry = np.searchsorted(stop, at, side="right")
            row = row_of[entry]
            place = start[row] + at - row_begins[row]
            here = place // width == stretch[row]  # a run may lie in two stretches
            if not here.all():
                entry, row, place = entry[here], row[here], place[here]
            if not len(row):
                continue
            segment = place // size
            opens = np.flatnonzero(np.append(True, (code[row[1:]] != code[row[:-1]]) | (segment[1:] != segment[:-1])))
            taken, amounts = names.take(pa.array(entry)), number[entry]
            first, last = opens[1] if len(opens) > 1 else len(row), opens[-1]
            as_first = (key[int(row[0])].as_py(), int(segment[0]))
            if as_first != open_as:
                if parts:
                    yield closed()
                open_as, open_row, parts = as_first, (key[int(row[0]) : int(row[0]) + 1], total[row[:1]], segment[:1]), []
            parts.append((taken[:first], amounts[:first]))
            if len(opens) == 1:
                continue
            yield closed()
            if len(opens) > 2:
                middle = opens[1:-1]
                yield rows(
                    key.take(pa.array(row[middle])), total[row[middle]], segment[middle], opens[1:] - first,
                    taken[first:last], amounts[first:last],
                )
            open_row = (key[int(row[last]) : int(row[last]) + 1], total[row[last : last + 1]], segment[last : last + 1])
            open_as, parts = (key[int(row[last])].as_py(), int(segment[last])), [(taken[last:], amounts[last:])]
    if parts:
        yield closed()
