"""The registered queries against their SQL, and the pipeline against brute force, on the smallest tables."""

import os
import re
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from sparrowmill.llm import bands, classifier
from sparrowmill.llm.queries import QUERIES, SQL
from sparrowmill.llm.token_ids import BYTE_BPE

from .test_jaccard import brute as components
from .test_rules_tokens import repeats
from .test_substrings import brute as substrings
from .test_suffixes import plain_dedup

SF_DIR = contract.SMOKE_DIR
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@needs_tables
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)

    def rows(table):
        return sorted(map(repr, zip(*[table.column(c).to_pylist() for c in columns], strict=True)))

    assert rows(got) == rows(want)


@needs_tables
def test_suffix_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op11_suffix_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=repr) == plain_dedup(rows, 200)


def kept_words(texts, size):
    """The words of each text that no repeated window covers."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    seen = {}
    for ws in words:
        for k in range(len(ws) - size + 1):
            seen[tuple(ws[k : k + size])] = seen.get(tuple(ws[k : k + size]), 0) + 1
    out = []
    for ws in words:
        gone = set()
        for k in range(len(ws) - size + 1):
            if seen[tuple(ws[k : k + size])] > 1:
                gone.update(range(k, k + size))
        out.append(" ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = classifier.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    accepted = {r.doc_id for r in classifier.score(docs, model).where("predicted = 1").collect()}
    packer = zstandard.ZstdCompressor(level=bands.LEVEL)
    kept = []
    for i in sorted(accepted):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i])
        if len(words) >= 50 and 2 * repeats(words) <= len(words) and bands.verdict(packer, texts[i].encode())[2]:
            kept.append((i, texts[i]))
    kept = [(i, texts[i]) for i, _, c in components(kept) if i == c]
    cut = []
    for (i, text), (_, removed, digest) in zip(kept, substrings([t for _, t in kept], 35), strict=True):
        cut.append((i, text, removed, digest))
    got = {}
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {i for i, *_ in cut}
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    assert any(removed for _, _, removed, _ in cut)
    for (i, text, removed, _), rest in zip(cut, kept_words([t for _, t in kept], 35), strict=True):
        pieces = sorted(got[i], key=lambda r: r.start)
        ids = [*tokenizer.encode(rest if removed else text, add_special_tokens=False).ids, 1]
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    sequences = {}
    for r in (r for pieces in got.values() for r in pieces):
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [a for a, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048


@needs_tables
def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows and clashing names pass every stage; so does an empty table."""
    prose = next(r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect() if len(r.text) > 2000)
    rows = [(1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0), (4, "few words", "en", None, 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, salts string, node int"
    for some in ([(*r, "s", 7) for r in rows], []):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns and out.count() <= len(some)
        assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()} == {r[0] for r in some}
