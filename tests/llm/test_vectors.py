"""Vector codes and hard negatives against brute force."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import cover_codes, hard_negatives, int_vectors
from sparrowmill.operators import skew

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def table(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 0.3, (7, dims))
    rows = []
    for i in range(n):
        x = centers[rng.integers(7)] + rng.normal(0, 0.1, dims)
        rows.append((i, [float(np.float32(v)) for v in x], int(rng.integers(labels))))
    return rows


def odd_rows(dims):
    """Rows that take no part, and rows that are there twice."""
    out = [(900, None, 1), (901, [], 1), (902, [None] + [0.5] * (dims - 1), 2), (950, [float("nan")] * dims, 3)]
    out += [(904, [float("inf")] + [0.0] * (dims - 1), 0)]
    out += [(50, [0.25] * dims, 1)] * 2 + [(7, [0.25] * dims, None), (None, [0.125] * dims, 1)]
    return out


# --- vector codes ----------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    kept = sorted(
        ((i, whole(v), lab) for i, v, lab in rows if usable(v)), key=lambda r: (r[0] is None, r[0] or 0, r[1])
    )
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[i][p] for i in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        out = []
        for pieces in cut:
            near = []
            for p, x in enumerate(pieces):
                gaps = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
                near.append((min(gaps), gaps.index(min(gaps))))
            out.append(near)
        return out

    for _ in range(rounds):
        now = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(cut)) if now[i][p][1] == e]
                if mine:
                    books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    now = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(g for g, _ in near) for near in now]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    return [
        (i, "".join(f"{c:02x}" for _, c in near), e, by_label[lab], digest)
        for (i, _, lab), near, e in zip(kept, now, errors, strict=True)
    ]


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("broadcast_bytes", [-1, 64 << 20])
def test_codes(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast_bytes)
    rows = table(400, 16, 1) + odd_rows(16)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("x")).withColumn("key_hash", F.lit(1)).repartition(3)
    got = cover_codes.vector_codes(df, parts=4, entries=8)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert in_order(map(tuple, got.collect())) == in_order(plain_codes(rows, 4, 8, 2))


def test_codes_of_few_and_none(spark):
    few = table(5, 8, 2)
    got = cover_codes.vector_codes(spark.createDataFrame(few, SCHEMA), parts=4, entries=8).collect()
    assert in_order(map(tuple, got)) == in_order(plain_codes(few, 4, 8, 2))
    for none in ([], [(1, None, 1), (2, [], None)]):
        assert cover_codes.vector_codes(spark.createDataFrame(none, SCHEMA)).collect() == []
    bad = spark.createDataFrame([(1, [0.5] * 6, 1)], SCHEMA)
    with pytest.raises(Exception, match="parts|reshape"):
        cover_codes.vector_codes(bad, parts=4).collect()


@pytest.mark.parametrize("leaf, most", [(1, 3), (4, 96), (24, 8)])
def test_trees(leaf, most):
    """Children cover their node, sums are cumulative, and the search equals the full one, ties included."""
    rng = np.random.default_rng(leaf)
    rows = np.concatenate([rng.integers(-6, 6, (300, 6)), np.full((70, 6), 2), rng.integers(-90, 90, (200, 6))])
    forest = cover_codes.plant(rows, 3, leaf, most)
    for i in range(len(forest.low)):
        mine = forest.points[forest.order[forest.low[i] : forest.high[i]]]
        assert (mine.sum(axis=0) == forest.total[i]).all()
        gap = np.sqrt(((mine - forest.points[forest.center[i]]) ** 2).sum(axis=1)).max()
        assert gap <= forest.radius[i] + 1e-9
        kids = np.arange(forest.child[i], forest.child[i] + forest.children[i])
        if len(kids):
            assert sorted(np.concatenate([np.arange(forest.low[k], forest.high[k]) for k in kids])) == list(
                range(forest.low[i], forest.high[i])
            )
    forest = cover_codes.Forest.load(forest.dump())
    books = rng.integers(-8, 8, (3, 20, 2))
    books[:, 7] = books[:, 3]
    counts, sums, codes = cover_codes.nearest(forest, books, each=True)
    for p in range(3):
        mine = rows[:, 2 * p : 2 * p + 2]
        want = ((mine[:, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (codes.reshape(3, -1)[p] == want).all()
        assert (counts[p] == np.bincount(want, minlength=20)).all()
        for e in range(20):
            assert (sums[p, e] == mine[want == e].sum(axis=0)).all()


def test_subtrees_are_assigned_whole():
    """With entries far apart, hardly any point is compared by itself."""
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-9, 9, (2000, 2)) + shift for shift in (0, 10_000, -10_000)])
    forest = cover_codes.plant(rows, 1)
    counts, _, _ = cover_codes.nearest(forest, np.array([[[0, 0], [10_000, 10_000], [-10_000, -10_000]]]))
    assert counts.tolist() == [[2000, 2000, 2000]]
    root_and_children = 1 + forest.children[0]
    assert root_and_children < 20


# --- hard negatives --------------------------------------------------------


def plain_negatives(rows, every=50):
    kept = [(i, whole(v), lab) for i, v, lab in rows if usable(v) and i is not None and lab is not None]
    kept = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in kept]
    out = []
    for i, v, lab in kept:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, w, other in kept]
        positives = sorted((s, j) for s, j, other in scored if other == lab and j != i)[:5]
        for s, j in positives:
            fit = sorted((t, n) for t, n, other in scored if other != lab and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit)]
    return out


@pytest.mark.parametrize("block", [3, 1 << 15])
def test_negatives(spark, block):
    rows = table(700, 12, 4) + odd_rows(12) + [(1000 + i, [0.25] * 12, i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("slot", F.lit(2)).repartition(4)
    got = hard_negatives.hard_negatives(
        df, label=hard_negatives.planted_labels(), is_anchor=F.col("vec_id") % 50 == 0, block=block
    )
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows)
    assert want and in_order(map(tuple, got.collect())) == in_order(want)


def test_negatives_of_none(spark):
    for rows in ([], [(50, None, 1)], [(50, [1.0], 1)], [(50, [1.0], 1), (51, [1.0], 1)]):
        assert hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []


@pytest.mark.parametrize("most", [3, 160, 1 << 12, 1 << 20, 1 << 27])
def test_packed_scores(most):
    rng = np.random.default_rng(most)
    anchors, rows = rng.integers(-most, most + 1, (9, 11)), rng.integers(-most, most + 1, (70, 11))
    for a, b in ((anchors, rows), (abs(anchors), rows), (anchors, -abs(rows)), (anchors[:0], rows), (anchors * 0, rows)):
        packed = hard_negatives.Packed.of(b, hard_negatives.field_bits(a, b))
        assert packed.fields >= 2 and (packed.scores(a) == a @ b.T).all()
        got = np.zeros((len(a), len(b)), np.int64)
        for i, j, score in hard_negatives.tiles(a, b):
            got[i : i + score.shape[0], j : j + score.shape[1]] = score
        assert (got == a @ b.T).all()


def test_best_keeps_ties_by_id():
    best = hard_negatives.Best(2, 2)
    for ids in ([5, 9], [3, 4], [1, 8]):
        best.add(np.zeros(2, np.int64), np.array([10, 10]), np.array(ids))
        best.settle()
    assert best.id.tolist() == [1, 3] and best.bar[0] == 10


def test_integers():
    column = pa.array([[0.5, -0.001], None, [], [None, 1.0], [float("nan"), 1.0], [1.0, -1.0]], pa.list_(pa.float32()))
    good, rows = int_vectors.integers(column.slice(0))
    assert good.tolist() == [True, False, False, False, False, True]
    assert rows.tolist() == [[128, -1], [256, -256]]
    assert int_vectors.integers(column.slice(1, 2))[1].shape == (0, 0)
    with pytest.raises(ValueError, match="different lengths"):
        int_vectors.integers(pa.array([[1.0], [1.0, 2.0]]))
    with pytest.raises(ValueError, match="in size"):
        int_vectors.integers(pa.array([[1e30]]))
