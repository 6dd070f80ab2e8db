"""Sorted per-key lists whose rows stay bounded however large a key is."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .skew import sized_join, text_bytes

# Rows of this many list items are still comfortable for one task.
LIST_SIZE = 100_000
# Rows that are stored as one, compressed: of some kinds of rows, and of one key in order.
ROWS_STORED = 100_000
RUN_ROWS = 1_000_000


def bounded_lists(
    rows: DataFrame,
    key: str,
    order: list[str],
    items: list[str],
    copies: str | None = None,
    size: int = LIST_SIZE,
    most: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """``(key, total, segment, items ARRAY<STRUCT>)`` with the items of each key in order.

    A key with up to ``size`` items is one row, segment 0. A larger one is cut
    into full segments numbered in order, so that joining its segments gives
    the whole sorted list. ``copies`` repeats an item; equal rows are as many items.

    A key of up to ``LIST_SIZE`` items, or ``size`` where that is more, is put
    together in one task and cut there. Which keys may be larger is found out first:
    ``most``, a table ``(key, most)`` with no fewer than the items of each key, is
    cheaper than counting ``rows``, which is done without it. With ``at_most``, a
    number that no key exceeds, not even that is needed while it is small. If there
    are no larger keys, nothing is stored. Otherwise the rows of these keys alone are,
    compressed, then range-partitioned on key and order, which spreads one key over
    many tasks, and stored once more as runs of a key in order. An item's place in its
    list is the number of items in the earlier runs of the key plus its place in its own.
    """
    sort_by = order + [c for c in items if c not in order]
    count = F.col(copies) if copies else F.lit(1)
    rows = rows.select(key, *sort_by, count.cast("bigint").alias("copies"))
    room = max(size, LIST_SIZE)
    if at_most is not None and at_most <= room:
        return _in_one_task(rows, key, sort_by, items, copies, size)
    if most is None:
        most = rows.groupBy(key).agg(F.sum("copies").alias("most"))

    # At most one for every ``LIST_SIZE`` items; stored, as they are read again.
    suspects = cut_lineage(most.where(F.col("most") > room).select(key, "most"))
    suspect_bytes = suspects.agg(text_bytes(key)).first()[0]
    if suspect_bytes == 0:
        return _in_one_task(rows, key, sort_by, items, copies, size)
    light = sized_join(rows, suspects, suspect_bytes, key, "most", sort_by, "left_anti")
    heavy = sized_join(rows, suspects, suspect_bytes, key, "most", sort_by, "left_semi")
    return _in_one_task(light, key, sort_by, items, copies, size).unionByName(
        _over_tasks(_stored(heavy), key, sort_by, items, copies, size)
    )


def _in_one_task(
    rows: DataFrame, key: str, sort_by: list[str], items: list[str], copies: str | None, size: int
) -> DataFrame:
    """The lists of keys small enough to be put together whole."""
    fields = [*sort_by, "copies"] if copies else sort_by
    # A row travels once, as it is; partial lists of a task would be short, and sorting them costs more.
    lists = (
        rows.repartition(key).groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("items"), F.sum("copies").alias("total"))
    )
    if fields != items:

        def item(x):
            return F.struct(*[x[c].alias(c) for c in items])

        if copies:
            unfolded = F.flatten(F.transform("items", lambda x: F.array_repeat(item(x), x["copies"].cast("int"))))
        else:
            unfolded = F.transform("items", item)
        lists = lists.withColumn("items", unfolded)
    if size >= LIST_SIZE:
        return lists.select(key, "total", F.lit(0).cast("bigint").alias("segment"), "items")
    last = F.expr(f"(size(items) - 1) div {size}")
    return lists.select(key, "total", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("segment"), "items").select(
        key, "total", "segment", F.expr(f"slice(items, int(segment * {size} + 1), {size})").alias("items")
    )


def _over_tasks(
    rows: DataFrame, key: str, sort_by: list[str], items: list[str], copies: str | None, size: int
) -> DataFrame:
    """The lists of keys too large for that."""
    kind = rows.schema
    run_rows = RUN_ROWS  # as it is here, not in a worker
    in_order = rows.repartitionByRange(key, *sort_by).sortWithinPartitions(key, *sort_by)
    # Stored, because run numbers come from sampled range bounds and all uses below must see the same ones.
    runs = cut_lineage(
        in_order.select(key, *items, *(["copies"] if copies else [])).mapInArrow(
            lambda batches: _runs(batches, bool(copies), run_rows),
            T.StructType([
                kind[key], T.StructField("task", T.IntegerType()), T.StructField("run", T.IntegerType()),
                T.StructField("n", T.LongType()), T.StructField("packed", T.BinaryType()),
            ]),
        )
    )
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("task", "run").rowsBetween(Window.unboundedPreceding, -1)
    # A few numbers for each run.
    places = F.broadcast(
        runs.select(key, "task", "run", "n").select(
            "task", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
            F.sum("n").over(of_key).alias("total"),
        )
    )
    placed = runs.join(places, ["task", "run"]).select(key, "total", "start", "n", "packed")
    listed = T.ArrayType(T.StructType([kind[c] for c in items]), False)
    cut_kind = T.StructType([
        kind[key], *(T.StructField(c, T.LongType()) for c in ("total", "segment", "at")), T.StructField("items", listed),
    ])

    def cut(whole: bool) -> DataFrame:
        return placed.mapInArrow(lambda batches: _segments(batches, size, bool(copies), whole), cut_kind)

    # Segments that lie in one run are done; the ends of runs meet those of the next ones.
    parts = F.sort_array(F.collect_list(F.struct("at", "items")))
    joined = (
        cut(False).groupBy(key, "total", "segment").agg(parts.alias("parts"))
        .select(key, "total", "segment", F.flatten("parts.items").alias("items"))
    )
    return cut(True).drop("at").unionByName(joined)


# -- stored rows ------------------------------------------------------------


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all().combine_chunks()


def _tables(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """The rows again, about ``n`` at a time."""
    held, n_held = [], 0
    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held >= n:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n_held = [], 0
    if n_held:
        yield pa.Table.from_batches(held).combine_chunks()


def _stored(rows: DataFrame) -> DataFrame:
    """``rows``, materialised with ``cut_lineage`` in a few bytes each."""

    def packed(batches):
        for table in _tables(batches, ROWS_STORED):
            yield pa.RecordBatch.from_arrays([pa.array([_pack(table)], pa.binary())], ["packed"])

    def unpacked(batches):
        for batch in batches:
            for value in batch.column(0):
                yield from _unpack(value.as_py()).to_batches(max_chunksize=10_000)

    return cut_lineage(rows.mapInArrow(packed, "packed binary")).mapInArrow(unpacked, rows.schema)


def _runs(batches: Iterable[pa.RecordBatch], copies: bool, run_rows: int) -> Iterator[pa.RecordBatch]:
    """``(key, task, run, n, packed)``: runs of rows of one key, in order, with their number of items."""
    task, run = TaskContext.get().partitionId(), 0
    for table in _tables(batches, run_rows):
        keys = table.column(0).combine_chunks()
        opens = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(opens) + 1), table.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = table.slice(low, high - low)
            n = pc.sum(part.column("copies")).as_py() if copies else high - low
            yield pa.RecordBatch.from_arrays(
                [
                    keys[low : low + 1], pa.array([task], pa.int32()), pa.array([run], pa.int32()),
                    pa.array([n], pa.int64()), pa.array([_pack(part.drop_columns(table.column_names[:1]))], pa.binary()),
                ],
                [table.column_names[0], "task", "run", "n", "packed"],
            )
            run += 1


def _segments(
    batches: Iterable[pa.RecordBatch], size: int, copies: bool, whole: bool
) -> Iterator[pa.RecordBatch]:
    """``(key, total, segment, at, items)``: segments that lie in one run, or else the parts of those that do not."""
    for batch in batches:
        for i in range(batch.num_rows):
            total, start, n = (batch.column(c)[i].as_py() for c in (1, 2, 3))
            end = start + n
            first, last = start // size, (end - 1) // size
            low, high = first, last + 1
            if start > first * size:
                low += 1
            if end < min((last + 1) * size, total):
                high -= 1
            # Those from ``low`` to ``high`` are whole.
            wanted = range(low, high) if whole else sorted({first, last} - set(range(low, high)))
            if not wanted:
                continue
            table = _unpack(batch.column(4)[i].as_py())
            count = table.column("copies").to_numpy() if copies else np.ones(n, np.int64)
            fields = table.drop_columns(["copies"]) if copies else table
            stop = start + np.cumsum(count)
            key = batch.column(0)[i : i + 1]
            per_batch = max(LIST_SIZE // size, 1)
            for at in range(0, len(wanted), per_batch):
                these = wanted[at : at + per_batch]
                begins = np.array([max(g * size, start) for g in these], np.int64)
                ends = np.array([min((g + 1) * size, end) for g in these], np.int64)
                # Those of a batch follow each other, or are the two ends of a run.
                places = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends, strict=True)])
                rows = pa.array(np.searchsorted(stop, places, side="right"))
                taken = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in fields.take(rows).columns]
                offsets = pa.array(np.append(0, np.cumsum(ends - begins)).astype(np.int32))
                listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(taken, fields.column_names))
                yield pa.RecordBatch.from_arrays(
                    [
                        key.take(pa.array(np.zeros(len(these), np.int64))), pa.array([total] * len(these), pa.int64()),
                        pa.array(list(these), pa.int64()), pa.array(begins), listed,
                    ],
                    [batch.schema.names[0], "total", "segment", "at", "items"],
                )
