"""Golden 1: lines, tokens, counts, pairs, PMI, stripes and the index."""

import math

import pytest
from pyspark.sql import functions as F

from sparrowmill.functions.text import sorted_terms, split_lines, tokenize, tokenize_ws
from sparrowmill.operators import counts, index, pairs
from sparrowmill.sources.text import corpus_lines, read_corpus, read_lines

A_TXT = "b a b c\na c\n"
B_TXT = "  c  d\n\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    (path / "a_1.txt").write_text(A_TXT)
    (path / "b.txt").write_text(B_TXT)
    return str(path)


@pytest.fixture(scope="module")
def corpus(spark, folder):
    return read_corpus(spark, folder)


def rows(df, *cols):
    return {tuple(r) for r in df.select(*(cols or df.columns)).collect()}


def test_lines(spark, folder, corpus):
    assert sorted(map(tuple, read_lines(spark, folder).collect())) == [
        ("", "b.txt"), ("  c  d", "b.txt"), ("a c", "a_1.txt"), ("b a b c", "a_1.txt"),
    ]
    table = spark.createDataFrame([("a_1.txt", A_TXT), ("b.txt", B_TXT), ("c", "")], "id string, text string")
    from_table = corpus_lines(table, "id", "text")
    assert rows(from_table, "doc", "line") == rows(corpus, "doc", "line")
    assert from_table.count() == 4


def test_line_ends(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd",), ("\n",), ("x\n\n",)], "t string")
    got = [r[0] for r in df.select(split_lines("t")).collect()]
    assert got == [["a", "b", "c", "d"], [""], ["x", ""]]


def test_tokens(spark):
    df = spark.createDataFrame([("  c\t d\x0be\f",), ("",), (" ",), ("b a b",)], "t string")
    got = df.select(
        tokenize("t"), tokenize_ws("t"), tokenize_ws("t", keep_empty=True), sorted_terms(tokenize("t"))
    ).collect()
    assert list(got[0]) == [["c", "d\x0be"], ["c", "d", "e"], ["", "c", "d", "e"], ["c", "d\x0be"]]
    assert list(got[1]) == [[], [], [""], []]
    assert list(got[2]) == [[], [], [], []]
    assert got[3][3] == ["a", "b"]


def test_counts(corpus):
    records = counts.tokenized(corpus)
    assert rows(counts.word_count(records)) == {("a", 2), ("b", 2), ("c", 3), ("d", 1)}
    assert rows(counts.doc_frequency(records)) == {("a", 2), ("b", 1), ("c", 3), ("d", 1)}
    assert ("a_1.txt", "b", 2) in rows(counts.term_frequency(corpus))


DOCFREQ = {("a", "b"): 1, ("a", "c"): 2, ("b", "c"): 1, ("c", "d"): 1}
POSITIONAL = {("b", "a"): 1, ("b", "b"): 1, ("b", "c"): 2, ("a", "b"): 1, ("a", "c"): 2, ("c", "d"): 1}


@pytest.mark.parametrize("mode, golden", [("docfreq", DOCFREQ), ("positional", POSITIONAL)])
@pytest.mark.parametrize("chunk", [1, 2, 512])
def test_pairs(corpus, mode, golden, chunk):
    got = {(r.left, r.right): r.pair_count for r in pairs.cooccurrence(corpus, mode, chunk=chunk).collect()}
    assert got == golden


def scores(df):
    return {(r.left, r.right): round(r.pmi, 6) for r in df.collect()}


def test_pmi_docfreq(corpus):
    by_hundred = {p: 3.912023 if p == ("a", "b") else 3.506558 for p in DOCFREQ}
    assert scores(pairs.pmi(corpus, n_docs=100)) == by_hundred
    assert scores(pairs.pmi(corpus)) == {p: 0.693147 if p == ("a", "b") else 0.287682 for p in DOCFREQ}


def test_pmi_positional(corpus):
    golden = {p: 3.218876 if p in {("a", "b"), ("b", "a"), ("b", "b")} else 3.506558 for p in POSITIONAL}
    assert scores(pairs.pmi(corpus, "positional", n_docs=100)) == golden
    striped = pairs.pmi_stripes(corpus, n_docs=100)
    assert scores(pairs.explode_stripes(striped, "pmi")) == golden


def test_stripes(corpus):
    got = {r.left: r.stripe for r in pairs.stripes(corpus).collect()}
    assert got == {"a": {"b": 1, "c": 2}, "b": {"a": 1, "b": 1, "c": 2}, "c": {"d": 1}}
    cut = pairs.stripes(corpus, size=2)
    assert rows(pairs.explode_stripes(cut, "n")) == {(l, r, n) for (l, r), n in POSITIONAL.items()}
    assert {(r.left, r.segment): set(r.stripe) for r in cut.collect()}[("b", 0)] == {"a", "b"}


def rendered(df):
    return sorted((r.key, r.segment, r.value) for r in index.render_index(df).collect())


def test_index_document(corpus):
    golden = [
        ("a 1", 0, "(a_1.txt,2)"), ("b 1", 0, "(a_1.txt,2)"), ("c 2", 0, "(a_1.txt,2)(b.txt,1)"), ("d 1", 0, "(b.txt,1)"),
    ]
    assert rendered(index.inverted_index(corpus)) == golden


def test_index_record(corpus):
    golden = [
        (" 2", 0, "(b.txt,1)(b.txt,1)"),
        ("a 2", 0, "(a_1.txt,1)(a_1.txt,1)"),
        ("b 1", 0, "(a_1.txt,2)"),
        ("c 3", 0, "(a_1.txt,1)(a_1.txt,1)(b.txt,1)"),
        ("d 1", 0, "(b.txt,1)"),
    ]
    assert rendered(index.inverted_index(corpus, "record", keep_empty=True)) == golden
    cut = [(k, v) for k, s, v in rendered(index.inverted_index(corpus, "record", size=2)) if k == "c 3"]
    assert cut == [("c 3", "(a_1.txt,1)(a_1.txt,1)"), ("c 3", "(b.txt,1)")]


def test_posting_order(spark):
    table = spark.createDataFrame([("a", "w\n" * 1 + " ".join(["w"] * 2) + "\n" + " ".join(["w"] * 10))], "id string, text string")
    corpus = corpus_lines(table, "id", "text")
    by_text = index.inverted_index(corpus, "record", order="text")
    by_struct = index.inverted_index(corpus, "record")
    assert rendered(by_text)[0][2] == "(a,1)(a,10)(a,2)"
    assert rendered(by_struct)[0][2] == "(a,1)(a,2)(a,10)"


def test_key_collision(spark):
    table = spark.createDataFrame([("1", "a,b c\na b,c")], "id string, text string")
    got = rows(pairs.cooccurrence(corpus_lines(table, "id", "text"), "positional"), "left", "right")
    assert got == {("a,b", "c"), ("a", "b,c")}


def test_bad_arguments(corpus):
    with pytest.raises(ValueError):
        pairs.pmi(corpus, mode="other")
    with pytest.raises(ValueError):
        index.inverted_index(corpus, order="other")
