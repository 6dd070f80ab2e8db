"""Fingerprints, archives and the streaming tokenizer against brute force."""

import base64
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparrowmill.llm import bpe_stream, fingerprints, warc


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvwé") for _ in range(r.randint(2, 9))) for _ in range(n))


TEXTS = [None, "", "short", prose(1, 300), prose(2, 900), prose(1, 300), "z" * 5000, prose(3, 4000), "é" * 10, prose(4, 60)]


def entropy_levels(data):
    out = []
    for i in range(len(data) - 63):
        _, counts = np.unique(data[i : i + 64], return_counts=True)
        value = 6 - (counts * np.log2(counts)).sum() / 64
        out.append(value * (fingerprints.LEVELS - 1) / 6)
    return np.array(out)


def test_window_levels():
    for text in (prose(5, 400), "a" * 64, "ab" * 700, "x" * 63):
        data = np.frombuffer(text.encode(), np.uint8)
        got, want = fingerprints.window_levels(data), entropy_levels(data)
        assert len(got) == len(want) and (np.abs(got - want) <= 0.51).all()


def test_features_by_hand():
    ranks = np.random.default_rng(1).permutation(fingerprints.LEVELS)
    texts = [prose(6, 200).encode(), b"", prose(7, 30).encode(), b"q" * 400]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    place, text = fingerprints.features(np.frombuffer(b"".join(texts), np.uint8), offsets, ranks)
    for i, t in enumerate(texts):
        levels = fingerprints.window_levels(np.frombuffer(t, np.uint8))
        wins = {}
        for a in range(len(levels) - fingerprints.NEIGHBOURS + 1):
            best = min(range(a, a + fingerprints.NEIGHBOURS), key=lambda p: (ranks[levels[p]], p))
            wins[best] = wins.get(best, 0) + 1
        want = sorted(p for p, n in wins.items() if n >= fingerprints.POPULAR)
        assert (place[text == i] - offsets[i]).tolist() == want


@pytest.mark.parametrize("rows_per_part", [3, 2000])
def test_fingerprint_documents(spark, rows_per_part):
    ids = [*range(0, 30, 3), 12, None, 27]
    texts = [*TEXTS, TEXTS[4], prose(8, 50), TEXTS[9]]
    rows = [(i, t, "x") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    got = fingerprints.fingerprint_documents(docs, rows_per_part=rows_per_part).collect()
    assert len(got) == len(rows)
    key = {}  # where ids are unique, the next row is known
    order = sorted(set(i for i in ids if i is not None), reverse=True)
    of = {i: t or "" for i, t in zip(ids, texts, strict=True)}
    ranks = fingerprints.level_ranks(docs)
    for a, b in zip(order[:-1], order[1:], strict=True):
        key[a] = fingerprints.edited_text(of[a], of[b])
    key[0] = fingerprints.edited_text("", "")
    for r in got:
        if r.doc_id is None or r.doc_id in (12, 27):
            continue
        text = of[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(key[r.doc_id].encode()).hexdigest()
        one, two = fingerprints.fingerprints([text.encode(), key[r.doc_id].encode()], ranks)
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.encoded(one), fingerprints.encoded(two))
        assert r.near_edited == fingerprints.likeness(one, two)
    by_text = {}
    for r in got:
        if r.doc_id is not None:
            by_text.setdefault(of[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    long = [r for r in got if r.doc_id in (9, 21)]
    assert all(r.near_edited > 0.4 and r.near_next < 0.2 for r in long), [(r.doc_id, r.near_edited, r.near_next) for r in long]
    assert len(base64.b64decode(long[0].fingerprint)) % (fingerprints.BITS // 8) == 0


def test_fingerprints_of_few(spark):
    docs = spark.createDataFrame([(7, prose(9, 200))], "doc_id long, text string")
    only = fingerprints.fingerprint_documents(docs).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    assert fingerprints.fingerprint_documents(docs.limit(0)).count() == 0


def test_short_texts_differ():
    ranks = np.arange(fingerprints.LEVELS)
    texts = [prose(20 + i, 100)[:n] for i, n in enumerate([1, 3, 8, 20, 40, 64, 80, 94, 105, 105])] + ["z" * 3000, "y" * 400]
    chains = fingerprints.fingerprints([t.encode() for t in [*texts, texts[8], ""]], ranks)
    assert all(len(c) for c in chains[:-1]) and not len(chains[-1])
    assert np.array_equal(chains[8], chains[-2])
    for i in range(len(texts)):
        for j in range(i):
            assert fingerprints.likeness(chains[i], chains[j]) < 0.3, (i, j)
    # An edit of a third shows, and leaves a likeness.
    one, two = texts[8], fingerprints.edited_text(texts[8], texts[9])
    edited = fingerprints.likeness(*fingerprints.fingerprints([one.encode(), two.encode()], ranks))
    assert 0.3 < edited < 0.95


def test_archives(spark):
    big, other = "<p>" + prose(10, 400) + "</p>", "ü" * 600
    rows = [
        (1, "http://a/1", big), (2, "http://a/2", "small"), (3, None, "small"), (4, "http://a/4\r\nX: y", big),
        (5, "u", None), (6, "u", ""), (7, "u", other), (8, "u", other), (8, "u", other), (None, "n", big), (None, "n", "z" * 1000),
        (9, "u", "\r\n\r\n" * 300),
    ]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, record_type string")
    got = warc.archived(pages.repartition(3)).collect()
    assert len(got) == len(rows)
    targets = {big: 4, other: 8}
    want = []
    for key, _, html in rows:
        data = (html or "").encode()
        target = targets.get(html)
        target = target if target != key else None
        kind = "revisit" if target is not None else "response"
        want.append((key, len(data), hashlib.sha1(data).hexdigest(), kind, target))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert warc.archived(pages.limit(0)).count() == 0


def test_archive_files(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(i, f"u{i}", prose(i, 300)) for i in range(40)], "page_id long, url string, html string")
    path = str(tmp_path / "out")
    warc.write_archives(pages.coalesce(1), path, archive_bytes=5000)
    archives = spark.read.parquet(path)
    names = sorted(r.archive for r in archives.select("archive").collect())
    assert len(names) > 5
    warc.export(archives, names[0], str(tmp_path / names[0]))
    assert gzip.open(tmp_path / names[0]).read().startswith(b"WARC/1.1\r\n")
    back = {r.page_id: r.html for r in warc.read_archives(archives, keep=True).collect()}
    assert back == {i: prose(i, 300) for i in range(40)}


def test_broken_archives():
    record = warc.write_record(1, "u", b"payload " * 400, None)
    tiny = [record[i : i + 7] for i in range(0, len(record), 7)] * 2
    assert len([warc.read_record(p) for p in warc.members(tiny)]) == 2
    with pytest.raises(ValueError, match="inside"):
        [warc.read_record(p) for p in warc.members([record[:-20]])]
    changed = record[:0] + warc.zlib.compress(warc.zlib.decompress(record, 31).replace(b"payload payload", b"payloaD payload", 1), wbits=31)
    with pytest.raises(ValueError, match="digest"):
        [warc.read_record(p) for p in warc.members([changed])]


def test_streaming_bpe(spark):
    library = Tokenizer.from_file(bpe_stream.WORD_BPE)
    r = random.Random(4)
    texts = [
        None, "", " \n", "Hello WORLD don't 123½", "ΣΑΣ İ ß", "a<|endoftext|>B <|startoftext|>", "日本語 テキスト", "aab" * 300,
        "the" * 400, "🎉👨‍👩‍👧!!", "x" * 3000, *("".join(r.choice("abcdethinsro ") for _ in range(300)) for _ in range(30)),
    ]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "null id", 0), (3, texts[3], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe_stream.encode_decode(docs.repartition(3), keep=True).collect()
    assert len(got) == len(rows)
    for g in got:
        ids = library.encode(("null id" if g.doc_id is None else texts[g.doc_id]) or "", add_special_tokens=False).ids
        assert g.ids == ids and g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_stream.encode_decode(docs.limit(0)).count() == 0


def test_transducer_memory_and_definition():
    coder = bpe_stream.codec()
    machine = bpe_stream.Transducer(coder.m)
    word = "".join(random.Random(6).choice("thereinandofaster") for _ in range(20_000))
    out, most = [], 0
    for c in word[:-1]:
        out += machine.feed([c])
        most = max(most, len(machine.tokens))
    out += machine.feed([word[-1] + coder.suffix]) + machine.finish()
    assert most <= 8 * coder.m.lookahead
    library = Tokenizer.from_file(bpe_stream.WORD_BPE)
    assert out == library.encode(word, add_special_tokens=False).ids
    assert "".join(coder.decode_text(out)) == word + " "


def test_text_decoder():
    text = "aé日🎉b"
    machine = bpe_stream.TextDecoder()
    pieces = [machine.push(bytes([b])) for b in text.encode()]
    assert "".join(pieces) == text and all(len(p) <= 1 for p in pieces)
    machine.push("日".encode()[:2])
    assert machine.finish() == "�"
