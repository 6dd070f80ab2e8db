"""Substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import fmindex
from sparrowmill.operators import skew


def brute(texts, size):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)

    def words(n, kinds=400):
        return [f"w{r.randrange(kinds)}" for _ in range(n)]

    passage, other = words(60), words(36)
    texts = [None, "", " \n", "one two", " ".join(words(34)), " ".join(words(35))]
    texts += [" ".join(words(r.randrange(40)) + passage + words(r.randrange(40))) for _ in range(9)]
    texts += [" ".join(words(10) + passage[:34] + words(10)) for _ in range(3)]
    texts += ["\n".join(words(20) + other + words(3) + other), "a b " * 60, "z " * 35, "z " * 34, "c d e " * 40]
    base = words(300)
    for _ in range(8):
        near = list(base)
        for _ in range(4):
            near[r.randrange(len(near))] = f"edit{r.random()}"
        texts.append(" ".join(near))
    texts += [" ".join(base)] * 3 + [" ".join(words(80, 3)) for _ in range(4)]
    texts += ["é" * 4000 + " " + " ".join(passage)]
    return texts


def test_index():
    r = np.random.default_rng(3)
    parts = [r.integers(0, 4, n).astype(np.uint64) for n in (50, 1, 30, 80, 62)] + [np.zeros(40, np.uint64)]
    index = fmindex.FMIndex(parts)
    for length in (1, 3, 5, 9):
        seen = Counter(tuple(p[i : i + length].tolist()) for p in parts for i in range(len(p) - length + 1))
        for k, p in enumerate(parts):
            if len(p) < length:
                continue
            ends = index.first[k] + np.arange(length, len(p) + 1)
            want = [seen[tuple(p[i : i + length].tolist())] > 1 for i in range(len(p) - length + 1)]
            assert index.repeated(ends, length).tolist() == want
    seen = Counter(tuple(p[i : i + 6].tolist()) for p in parts for i in range(len(p) - 5))
    for p, bits in zip(parts, index.windows(6), strict=True):
        assert [bool(int(bits) >> i & 1) for i in range(max(0, min(len(p) - 5, 60)))] == [
            seen[tuple(p[i : i + 6].tolist())] > 1 for i in range(max(0, min(len(p) - 5, 60)))
        ]


@pytest.mark.parametrize(("seed", "hot"), [(1, 16_384), (2, 4)])
def test_substring_dedup(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(fmindex, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(fmindex, "SHARD_SEGMENTS", 40)
    texts = corpus(seed)
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)] + [(None, texts[6], 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, starts string").repartition(4)
    want = brute([*texts, texts[6]], 35)
    got = fmindex.substring_dedup(docs).collect()
    assert len(got) == len(rows)
    for g in got:
        assert (g.n_words, g.n_removed, g.kept_sha256) == want[-1 if g.doc_id is None else g.doc_id], g.doc_id
    kept = fmindex.kept_texts(docs)
    assert kept.columns == docs.columns
    for row in kept.collect():
        n, removed, digest = want[-1 if row.doc_id is None else row.doc_id]
        if removed:
            assert hashlib.sha256(row.text.encode()).hexdigest() == digest
        else:
            assert row.doc_id is None or row.text == texts[row.doc_id]


def test_substring_dedup_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert fmindex.substring_dedup(docs.limit(0)).count() == 0
    assert fmindex.substring_dedup(docs).collect()[0].n_removed == 0


def test_a_passage_in_very_many_texts_is_dealt_over_tasks(spark, monkeypatch):
    """With every side shuffled, the segment of a passage that most texts hold has several salts."""
    found = {}
    plain = skew.salt_counts

    def spy(dim, key, weight, partitions):
        hot = plain(dim, key, weight, partitions)
        if key == "kind":
            most = dim.orderBy(F.desc(weight)).select(F.xxhash64(key), weight).first()
            found.update(most=most, salts={r[0]: r[1] for r in hot.collect()})
        return hot

    monkeypatch.setattr(skew, "salt_counts", spy)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(skew, "shuffle_partitions", lambda df: 64)  # the share that makes a key hot, as on a cluster
    r = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(200))  # longer than a segment, so some segments are equal
    texts = [" ".join(f"x{r.random()}" for _ in range(40)) + f" {passage} " + " ".join(f"y{r.random()}" for _ in range(40)) for _ in range(120)]
    texts += [f"{k % 30} " * 3 + " ".join(f"o{k % 30}w{i}" for i in range(50)) + f" e{k}" for k in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in fmindex.substring_dedup(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 35)
    key, places = found["most"]
    assert places >= 120 and found["salts"][key] > 1
