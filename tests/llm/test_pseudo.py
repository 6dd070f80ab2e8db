"""Pseudo-likelihood scores against a plain computation, and on shuffled text."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparrowmill.llm import pseudo


def sentences(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        noun = r.choice(["cat", "dog", "bird", "fish"])
        verb = {"cat": "purrs", "dog": "barks", "bird": "sings", "fish": "swims"}[noun]
        out.append(f"the {noun} {verb} {r.choice(['in', 'on', 'near'])} the {r.choice(['house', 'tree', 'lake'])} .")
    return " ".join(out)


def corpus(spark, n=200):
    rows = [(i, sentences(i, 20), 0) for i in range(n)] + [(None, "the cat purrs", 0), (3, sentences(3, 20), 0)]
    return spark.createDataFrame(rows + [(900, None, 0), (901, "", 0), (902, " \n", 0)], "doc_id long, text string, n_words int")


def test_scores_by_hand():
    texts = pa.array([sentences(1, 3), None, "", "The cat", sentences(2, 400)])
    bits = 12
    counts = np.bincount(pseudo._slots(texts, bits)[0], minlength=1 << bits)
    classes = pseudo.classes_of(counts)
    network = pseudo.Network.start(classes.n, np.zeros(classes.n))
    n_words, value = pseudo.score_texts(texts, classes, network, bits)
    for i, text in enumerate(texts.to_pylist()):
        slots = pseudo._slots(pa.array([text]), bits)[0]
        known = [int(classes.of[s]) for s in slots]
        total = 0.0
        for k, c in enumerate(known):
            h = network.bias.astype(float).copy()
            for side, shift in enumerate([-2, -1, 1, 2]):
                at = k + shift
                h += network.sides[side][known[at] if 0 <= at < len(known) else classes.n]
            logits = np.tanh(h) @ network.out + network.out_bias
            total += logits[c] - np.log(np.exp(logits).sum()) + classes.log_share[slots[k]]
        assert n_words[i] == len(known)
        assert value[i] == pytest.approx(total, abs=1e-2 + 1e-5 * len(known))
    # p(word | class) adds up to one in each class.
    assert np.allclose(np.bincount(classes.of, np.exp(classes.log_share.astype(float))), 1, atol=1e-3)


def test_gradient():
    r = np.random.default_rng(2)
    network = pseudo.Network.start(5, np.zeros(5))
    around, target = r.integers(0, 6, (4, 9)), r.integers(0, 5, 9)

    def loss(n):
        p = n.log_probabilities(around)
        return -p[np.arange(9), target].astype(float).mean()

    values = network.flat().astype(np.float64)
    moved = network.with_flat(values)
    squares = [np.zeros_like(p) for p in moved.parameters()]
    moved.learn(around, target, squares)
    gradient = np.sqrt(np.concatenate([s.ravel() for s in squares]))
    for at in r.choice(len(values), 25, replace=False):
        step = np.zeros(len(values))
        step[at] = 1e-2
        slope = (loss(network.with_flat(values + step)) - loss(network.with_flat(values - step))) / 2e-2
        assert abs(abs(slope) - gradient[at]) < 2e-3
    assert loss(moved) < loss(network)


def test_pseudo_likelihood(spark):
    docs = corpus(spark).repartition(3)
    rows = pseudo.pseudo_likelihood(docs, bits=12).collect()
    assert len(rows) == 205
    by_id = {r.doc_id: r for r in rows if r.doc_id != 3}
    for empty in (900, 901, 902):
        assert (by_id[empty].n_words, by_id[empty].log_likelihood, by_id[empty].mean_log_likelihood) == (0, 0.0, None)
    assert all(r.log_likelihood < 0 for r in rows if r.n_words)
    assert len({r.log_likelihood for r in rows if r.doc_id == 3}) == 1
    # The trained network prefers order, and beats the corpus counts alone.
    classes = pseudo.word_classes(docs, bits=12)
    network = pseudo.train(docs, classes, bits=12)
    held = [sentences(1000 + i, 20) for i in range(20)]
    mixed = [" ".join(random.Random(i).sample(t.split(), len(t.split()))) for i, t in enumerate(held)]
    straight, shuffled = (pseudo.score_texts(pa.array(t), classes, network, 12)[1].sum() for t in (held, mixed))
    flat = pseudo.Network.start(classes.n, np.zeros(classes.n))
    flat.out[:] = 0
    untrained = pseudo.score_texts(pa.array(held), classes, flat, 12)[1].sum()
    assert straight > shuffled and straight > untrained
    assert pseudo.pseudo_likelihood(docs.limit(0), bits=12).count() == 0


def test_words_by_hand():
    # Two bits of table: all words share places, and are told apart all the same.
    texts = ["the cat purrs", "The dog barks loud", None, "", "cat", "the cat barks the cat"]
    bits = 2
    classes = pseudo.classes_of(np.bincount(pseudo._slots(pa.array(texts), bits)[0], minlength=1 << bits))
    network = pseudo.Network.start(classes.n, np.zeros(classes.n))
    split = [["^", *(t or "").lower().split(), "$"] for t in texts]
    vocabulary = sorted({w for s in split for w in s[1:-1]})
    slot = {w: int(pseudo._slots(pa.array([w]), bits)[0][0]) for w in vocabulary}
    words = [w for s in split for w in s[1:-1]]
    couples = [c for s in split if len(s) > 2 for c in zip(s[:-1], s[1:], strict=True)]
    n_words, value = pseudo.score_block(pa.array(texts), classes, network, bits=bits)
    assert n_words.tolist() == [3, 4, 0, 0, 1, 5]
    for i, s in enumerate(split):
        total = 0.0
        for k in range(1, len(s) - 1):
            in_class = {}
            for c in range(classes.n):
                line = np.array([classes.of[slot[w]] for w in s[1:-1]])
                around = pseudo._around(line, np.array([0, len(line)]), classes.n)[:, k - 1 : k]
                in_class[c] = float(np.exp(network.log_probabilities(around)[0, c]))
            p = {}
            for w in vocabulary:
                c = classes.of[slot[w]]
                net = in_class[c] * words.count(w) / sum(classes.of[slot[x]] == c for x in words)
                p[w] = 0.0
                for pair, of, own in (
                    ((s[k - 1], w), [x for x in couples if x[0] == s[k - 1] and x[1] != "$"], (s[k - 1], s[k])),
                    ((w, s[k + 1]), [x for x in couples if x[1] == s[k + 1] and x[0] != "^"], (s[k], s[k + 1])),
                ):
                    of = list(of)
                    of.remove(own)
                    p[w] += (of.count(pair) + pseudo.PRIOR * net) / (len(of) + pseudo.PRIOR) / 2
            assert sum(p.values()) == pytest.approx(1, abs=1e-5) or len(set(classes.of[list(slot.values())])) < classes.n
            total += np.log(p[s[k]])
        assert value[i] == pytest.approx(total, abs=1e-4)


def test_rare_words_are_predicted(spark):
    # Two hundred couples of rare words, each seen alike often; the classes cannot tell them apart.
    r = random.Random(5)
    couples = [(f"left{i}", f"right{i}") for i in range(200)]
    texts = [" ".join(" ".join(r.choice(couples)) + " and" for _ in range(30)) for _ in range(200)]
    straight = " ".join(" ".join(couples[i]) + " and" for i in range(0, 40))
    swapped = " ".join(f"{couples[i][0]} {couples[(i + 7) % 40][1]} and" for i in range(0, 40))
    rows = [(i, t) for i, t in enumerate([straight, swapped, *texts])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    of = {}
    for size in (1 << 10, 1 << 23):  # many blocks and shards, or one
        for x in pseudo.pseudo_likelihood(docs, bits=12, block_bytes=size).collect():
            of.setdefault(x.doc_id, []).append(x.log_likelihood)
    assert len(of) == len(rows)
    assert of[0][1] > of[1][1] + 40  # over 40 exchanged words
    # What the blocks are does not matter, as far as training does not depend on the order of rows.
    assert all(a == pytest.approx(b, rel=0.01) for a, b in of.values())


def test_table_follows_the_corpus(spark):
    def counts(n):
        texts = [f"a{i} b{i} c{i}" for i in range(n)]
        rows = [(block, data) for block in (0, 1) for data in pseudo._zipped(pa.array(texts)).to_pylist()]
        blocks = spark.createDataFrame(rows, "block int, text binary")
        found = [pseudo._unpacked(r.data) for r in pseudo._corpus_counts(blocks, 3).collect()]
        assert sorted({int(c) for _, part in found for c in part[:, 0]}) == [2, 2 * n]
        return len({int(k) for part, _ in found for k in part})

    # Of each row three words and four pairs; and the edge.
    assert [counts(n) - 1 for n in (10, 1000)] == [7 * 10, 7 * 1000]
