"""External induced sorting and the byte-level dedup, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import induced_sort, suffix_dedup
from sparrowmill.operators import skew

# --- the sort --------------------------------------------------------------


def check(body, n_symbols, most, memory=induced_sort.MEMORY):
    text = np.append(np.asarray(body, np.int64), 0).astype(np.uint8 if n_symbols <= 256 else np.int64)
    disk = induced_sort.Disk(memory)
    got = list(induced_sort.suffixes(text, n_symbols, disk, most))
    disk.close()
    plain = text.tolist()
    want = sorted(range(len(plain)), key=lambda i: plain[i:], reverse=True)
    assert np.concatenate([p for p, _ in got]).tolist() == want
    if most:
        shared = np.concatenate([s for _, s in got]).tolist()
        for k in range(1, len(want)):
            a, b = plain[want[k - 1] :], plain[want[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(n, most)
    return disk


@pytest.mark.parametrize("batch, memory", [(1 << 18, 48 << 20), (4, 100), (16, 10)])
@pytest.mark.parametrize("small", [256, 1])
def test_short_texts(monkeypatch, batch, memory, small):
    monkeypatch.setattr(induced_sort, "BATCH", batch)
    monkeypatch.setattr(induced_sort, "SMALL", small)
    rng = np.random.default_rng(batch)
    for trial in range(60):
        body = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(0, 50)))
        if trial % 3 == 0:
            body = np.tile(body, 3)
        check(body, 5, 0 if small == 1 else [0, 5, 300][trial % 3], memory)


def test_runs_periods_and_wide_alphabets(monkeypatch):
    rng = np.random.default_rng(1)
    words = [rng.integers(1, 200, 8) for _ in range(20)]
    body = np.concatenate([[1] * 400, *[words[i] for i in rng.integers(0, 20, 150)], [7] * 300, [3] * 200, [9, 8] * 150])
    check(body, 201, 200)
    check(rng.integers(1, 400, 3000), 400, 0)
    check(np.tile(rng.integers(1, 900, 40), 30), 900, 0)
    monkeypatch.setattr(induced_sort, "BATCH", 64)
    disk = check(body, 201, 200, 5000)
    assert disk.end > 20_000  # the queues went to the file


# --- the dedup -------------------------------------------------------------


def plain_dedup(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] = seen.get(t[i : i + size], 0) + 1
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = [True] * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(k) for k in (15, 25, 60)]
    texts = [prose(rng.randint(0, 60)) for _ in range(40)]
    texts += [prose(5) + rng.choice(passages) + prose(9) for _ in range(40)]
    texts += [texts[3]] * 5 + [texts[50] + "!"] * 3 + [texts[60][7:]] + [texts[61][:-9] + "x"]
    texts += ["=" * 300, "=" * 120 + "ab" * 90, "ab" * 200, "", None, None, "né", "x" * 64, "x" * 63, "x" * 64]
    texts += [prose(900) + passages[2] * 3]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[55]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, anchor, hot", [(64, 16, 1 << 13), (64, 16, 2), (40, 40, 3), (90, 8, 10)])
def test_dedup(spark, monkeypatch, size, anchor, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_PLACES", 150)
    if hot == 2:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    rows = corpus(size + hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(1)).repartition(3)
    got = suffix_dedup.suffix_dedup(df, size=size, anchor=anchor)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_dedup(rows, size)


def test_kept_texts(spark):
    passage = "".join(random.Random(5).choices("abcdefgh ", k=150))
    rows = [(1, "one " + passage + " two", "a"), (2, passage[:120] + "ö", "b"), (3, None, "c"), (4, "kept", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, salts string")
    got = {r.doc_id: (r.text, r.salts) for r in suffix_dedup.kept_texts(df, size=100, anchor=16).collect()}
    assert got == {1: ("one " + passage[120:] + " two", "a"), 2: ("ö", "b"), 3: (None, "c"), 4: ("kept", "d")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.suffix_dedup(df).collect() == []


def test_blocks_and_dealing(monkeypatch):
    """Texts cut into blocks serve every start once, and equal strings keep their anchor's distance."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 2000).astype(np.uint8)
    data[1500:1700] = data[100:300]
    offsets = np.array([0, 0, 50, 990, 2000])
    grams = suffix_dedup._Grams(12)
    keys, places, first, last = suffix_dedup.segments(data, offsets, grams, 60)
    hot = np.arange(len(keys)) % 2 == 0
    route, of, a, b = suffix_dedup._dealt(keys, places, first, last, hot)
    starts = np.concatenate([np.arange(x, y + 1) for x, y in zip(a, b, strict=True)])
    want = [i for low, high in zip(offsets[:-1], offsets[1:], strict=True) for i in range(low, high - 59)]
    assert sorted(starts.tolist()) == want
    assert ((places[of] >= a) & (places[of] <= b + 60 - 12)).all()
    near = {int(s): int(places[o] - s) for x, y, o in zip(a, b, of, strict=True) for s in range(x, y + 1)}
    assert all(near[i] == near[i + 1400] for i in range(100, 241))
