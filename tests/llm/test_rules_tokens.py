"""Quality rules, classifier, packing and token files against brute force."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from sparrowmill.llm import bands, classifier, packing, repair, token_ids
from sparrowmill.llm import words as W
from sparrowmill.llm.token_ids import BYTE_BPE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The quick brown fox jumps over the lazy dog near river bank number"
TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c a b c", "Ünï çödé # <b>|x| 100% \n\nx\n x\nx\nyes\n",
    " ".join(f"w{i * i % 977}x{i}" for i in range(120)), "spam ham " * 400, "x" * 9000,
    " ".join(f"{PROSE} {i}" for i in range(6)), "<|endoftext|> a  b<|endoftext|>", "q\n" * 60,
    " ".join(f"v{i}" for i in range(6000)),
]


def frame(spark, texts=TEXTS, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, n_words int")


def repeats(words):
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({j + k for at in grams.values() if len(at) > 1 for j in at for k in range(3)})


def test_quality_rules(spark):
    docs = frame(spark, TEXTS + TEXTS[6:8] + ["z"], list(range(len(TEXTS))) + [6, 7, None]).repartition(3)
    got = bands.quality_rules(docs).collect()
    assert len(got) == len(TEXTS) + 3
    packer = zstandard.ZstdCompressor(level=bands.LEVEL)
    for row in got:
        text = ("z" if row.doc_id is None else TEXTS[row.doc_id]) or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == repeats(words)
        assert row.base_failed == (len(words) < 50 or 100 * repeats(words) > 50 * len(words))
        assert row.kept == (not row.base_failed and bands.verdict(packer, text.encode())[2])
    kept = bands.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_compression_verdicts():
    packer = zstandard.ZstdCompressor(level=bands.LEVEL)
    noise = np.random.default_rng(1).integers(0, 256, 20_000, dtype=np.uint8).tobytes()
    prose = " ".join(f"{w}{i % 89}" for i, w in enumerate((PROSE + " ") .split() * 60)).encode()
    assert not bands.verdict(packer, noise)[2]
    assert not bands.verdict(packer, b"again and " * 3000)[2]
    assert bands.verdict(packer, PROSE.encode())[2]
    assert bands.verdict(packer, prose)[0] > 1


def test_noise_and_half_junk():
    packer = zstandard.ZstdCompressor(level=bands.LEVEL)
    rng = np.random.default_rng(4)
    lower, printable = np.arange(97, 123, dtype=np.uint8), np.arange(33, 127, dtype=np.uint8)
    alnum = np.array([c for c in printable if chr(c).isalnum()], np.uint8)

    def noise(symbols, n):
        out = b""
        while len(out) < n:
            out += rng.choice(symbols, rng.integers(2, 10)).tobytes() + b" "
        return out[:n]

    for symbols, sizes in (
        (lower, (1200, 1500, 2000, 3000, 7000, 8500, 40_000, 100_000)),
        (alnum, (350, 500, 700, 1000, 1500, 3000, 7000, 20_000)),
        (printable, (350, 500, 700, 1000, 1500, 3000, 7000, 20_000)),
    ):
        for n in sizes:
            assert not any(bands.verdict(packer, noise(symbols, n))[2] for _ in range(10)), (len(symbols), n)
    # Words in proportions like those of a language: kept whole, not with repeated or random stretches.
    vocabulary = [noise(lower, rng.integers(3, 9)) for _ in range(1500)]
    odds = 1 / np.arange(1, 1501)

    def clean(n):
        return b" ".join(vocabulary[i] for i in rng.choice(1500, n, p=odds / odds.sum()))[:n]

    for n in (3000, 6000, 8500, 12_000, 20_000, 40_000):
        text = clean(n)
        assert bands.verdict(packer, text)[2], (n, bands.verdict(packer, text))
        part = 6 * n // 10
        again = (text[:part] + b"buy this now " * n)[:n]
        assert not bands.verdict(packer, again)[2], (n, bands.verdict(packer, again))
        if n >= 12_000:
            assert not bands.verdict(packer, text[:part] + noise(alnum, n - part))[2], n


def labelled(spark, n=400):
    good = ["the tree of the river was in a field with stones", "she went to the market and bought some bread"]
    bad = ["BUY!! NOW!! THE!! BEST!! DEAL!!", "win### cash*** now$$$ click%%% here&&&"]
    texts = [f"{(good if i % 3 else bad)[i % 2]} {i}" for i in range(n)]
    docs = frame(spark, texts).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier(spark):
    docs, labels = labelled(spark)
    model = classifier.train(docs, labels)
    rows = classifier.score(docs, model).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    # Held-out labels never matter, nor does the order of the rows.
    turned = classifier.train(
        docs.repartition(2, "text"),
        labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality"),
    )
    assert np.array_equal(model.weights, turned.weights)


def test_classifier_edges(spark):
    docs, labels = labelled(spark, 50)
    odd = frame(spark, [None, "", "fine words", "fine words"], [None, 1, 2, 2])
    model = classifier.train(docs, labels.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) doc_id, 1 quality, 0 toxic")))
    rows = classifier.score(odd, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    none = classifier.train(docs, labels.limit(0))
    assert {r.score for r in classifier.score(odd, none).collect()} == {0.5}
    assert classifier.score(odd.limit(0), none).count() == 0
    assert classifier.accepted_documents(docs, model).columns == docs.columns


def library_ids(text, end):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_differencing():
    sizes = [8, 7, 6, 5, 4]
    assert sorted(sum(sizes[i] for i in g) for g in packing.differencing(sizes, 2)) == [14, 16]
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = rng.integers(1, 100, rng.integers(1, 60)).tolist()
        groups = packing.divide(sizes, 100)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in g) for g in groups) <= 100


def test_pack(spark):
    texts, ids = TEXTS + TEXTS[5:8], [*range(len(TEXTS)), 5, 6, None]
    for parts in (1, 3):
        rows = packing.pack(frame(spark, texts, ids).repartition(parts)).collect()
        want = {}
        for i, t in zip(ids, texts, strict=True):
            want.setdefault(i, []).append(library_ids(t, 1))
        for key, copies in want.items():
            mine = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == key)
            assert sum(r[1] for r in mine) == sum(map(len, copies))
            assert {r[3] for r in mine} == {len(c) for c in copies}
            for start, length, value, _ in mine:
                assert any(value == crc(c[start : start + length]) for c in copies)
            if len(copies) == 1:
                assert [r[0] for r in mine] == list(np.cumsum([0, *[r[1] for r in mine]])[:-1])
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts_ in sequences.values():
            at = 0
            for offset, length in sorted(parts_):
                assert offset == at
                at += length
            assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two
    assert packing.pack(frame(spark).limit(0)).count() == 0
    shown = packing.pack(frame(spark, ["a b"]), keep_ids=True).collect()
    assert sum((r.ids for r in sorted(shown, key=lambda r: r.start)), []) == library_ids("a b", 1)


def test_repair_round_trip():
    rng = np.random.default_rng(5)
    for n, kinds in ((0, 3), (1, 3), (50, 1), (3000, 3), (5000, 40)):
        ids = rng.integers(0, kinds, n)
        cuts = np.unique(np.concatenate([[0, n], rng.integers(0, n + 1, 7)])) if n else np.array([0])
        payload = repair.write_block(ids, cuts, 100)
        assert n < 5000 or len(payload) < 2 * n
        block = repair.Block(payload)
        for i in range(len(cuts) - 1):
            assert block.document(i).tolist() == ids[cuts[i] : cuts[i + 1]].tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2))
            if a < b:
                assert block.read(a, b).tolist() == ids[a:b].tolist()
    repeated = np.tile(np.arange(8), 500)
    assert len(repair.compress(repeated, np.array([4000]), 100, rounds=6).symbols) < 1000


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(6)
    for n, kinds in ((20000, 3), (20000, 500), (30000, 1)):
        ids = rng.integers(0, kinds, n)
        ids[n // 2 :] = np.resize(ids[:97], n - n // 2)  # one passage, again and again
        cuts = np.arange(0, n + 1, 1000)
        grammar = repair.compress(ids, cuts[1:], 1000)
        lengths = grammar.lengths()
        assert (repair.expand(grammar, grammar.symbols, lengths) == ids).all()
        ends = np.cumsum(lengths[grammar.symbols])
        assert np.isin(cuts[1:], ends).all()  # no symbol reaches past a document
        inner = ~np.isin(ends[:-1], cuts)
        pairs = np.stack([grammar.symbols[:-1], grammar.symbols[1:]], 1)[inner]
        for pair, count in zip(*np.unique(pairs, axis=0, return_counts=True), strict=True):
            assert count < repair.LEAST_COUNT, pair
    for width in (1, 5, 17, 32):
        values = rng.integers(0, 1 << width, 70_001, dtype=np.uint64)
        values[0] = (1 << width) - 1
        raw = b"x" + repair.packed(values) + b"y"
        back, at = repair.unpacked(raw, 1, len(values))
        assert (back == values).all() and raw[at:] == b"y"


def test_pieces_of_one_hash_are_encoded_by_the_library(monkeypatch):
    codec = token_ids.Encoder(token_ids.BYTE_BPE)
    texts = pa.array(["one two, three", None, " four  five six\nseven"])
    want = [i for t in texts.to_pylist() for i in library_ids(t, 0)[:-1]]
    assert codec.encode(texts)[0].tolist() == want
    few = W.hash_spans
    monkeypatch.setattr(W, "hash_spans", lambda data, start, length, seed=0: few(data, start, length, seed) % (3 if seed == 0 else 1 << 60))
    codec = token_ids.Encoder(token_ids.BYTE_BPE)
    assert codec.encode(texts)[0].tolist() == want
    assert codec.encode(pa.array(["one"]))[0].tolist() == library_ids("one", 0)[:-1]
    assert codec.encode(pa.array(["two"]))[0].tolist() == library_ids("two", 0)[:-1]
    assert codec.encode(pa.array(["six"]))[0].tolist() == library_ids("six", 0)[:-1]


@pytest.mark.parametrize("block_tokens", [500, 1 << 20])
def test_token_files(spark, block_tokens):
    texts, ids = TEXTS + TEXTS[5:7], [*range(len(TEXTS)), 5, None]
    rows = repair.token_files(frame(spark, texts, ids).repartition(4), block_tokens=block_tokens).collect()
    assert len(rows) == len(texts)
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    at = 0
    for r, (key, text) in zip(sorted(rows, key=lambda r: r.start), order, strict=True):
        want = library_ids(text, 0)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key, at, len(want), crc(want))
        at += len(want)
    assert repair.token_files(frame(spark).limit(0)).count() == 0
