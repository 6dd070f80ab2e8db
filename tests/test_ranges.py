"""Lists put together from runs equal the plain ones, however rows, runs and stretches are cut."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparrowmill.functions.text import split_lines
from sparrowmill.operators import graph, index, lists, ranges


@pytest.fixture
def tiny(monkeypatch):
    """Every cut falls inside of documents, keys and segments."""
    for name, value in (("AT_ONCE", 40), ("RUN_ENTRIES", 4), ("ITEMS_PER_TASK", 30), ("ITEMS_PER_BATCH", 7)):
        monkeypatch.setattr(ranges, name, value)


def lines_of(docs, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]

    def line():
        return " ".join("hot" if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40])))

    return [(d, n, line()) for d in docs for n in range(rng.randint(1, 30))]


def shown(doc, tf):
    return f"({doc},{tf})"


def plain_index(lines, granularity, order, size):
    """Of ``(doc, line_no, line)``; lines of one number are one record."""
    units = {}
    for doc, n, line in lines:
        unit = (doc, n) if granularity == "record" else (doc, None)
        units.setdefault(unit, Counter()).update(line.split())
    found = {}
    for (doc, _), terms in units.items():
        for term, tf in terms.items():
            found.setdefault(term, []).append((doc, tf))
    by = {"text": lambda p: shown(*p), "struct": lambda p: (p[0] is not None, p[0] or "", p[1])}[order]
    return {
        (term, s // size): (len(ps), sorted(ps, key=by)[s : s + size])
        for term, ps in found.items() for s in range(0, len(ps), size)
    }


def as_found(indexed):
    rows = indexed.collect()
    got = {(r.term, r.segment): (r.df, [tuple(p) for p in r.postings]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("size", [1, 7, 100_000])
@pytest.mark.parametrize("granularity", ["document", "record"])
@pytest.mark.parametrize("order", ["struct", "text"])
def test_index(spark, tiny, granularity, order, size):
    # Some names begin others, with signs on either side of the comma and the digits after them.
    lines = lines_of(["a", "a!", "a0", "ab", "ä", "zz", *map(str, range(25))])
    lines += [line for line in lines if line[1] % 3 == 0]
    corpus = spark.createDataFrame(lines, "doc string, line_no int, line string").repartition(5)
    assert as_found(index.inverted_index(corpus, granularity, order=order, size=size)) == plain_index(
        lines, granularity, order, size
    )


@pytest.mark.parametrize("order", ["struct", "text"])
def test_index_of_names_with_commas(spark, tiny, order):
    lines = [(d, n, "x " * (n + 1)) for d in ("a", "a,5", "a,51", "b") for n in range(60)]
    corpus = spark.createDataFrame(lines, "doc string, line_no int, line string")
    assert as_found(index.inverted_index(corpus, "record", order=order)) == plain_index(lines, "record", order, 100_000)


def test_index_of_unnamed_and_empty_documents(spark, tiny):
    lines = [(None, 0, "x y x"), (None, 1, "x"), ("", 0, "x"), ("", 1, ""), ("b", 0, "  ")]
    corpus = spark.createDataFrame(lines, "doc string, line_no int, line string")
    for granularity in ("document", "record"):
        assert as_found(index.inverted_index(corpus, granularity)) == plain_index(lines, granularity, "struct", 100_000)
    kept = as_found(index.inverted_index(corpus, "record", keep_empty=True))
    assert kept["", 0] == (1, [("", 1)])
    assert index.inverted_index(corpus.where("false")).count() == 0


def test_postings_travel_packed(spark, monkeypatch):
    """Lists of any length are neither stored nor shuffled posting by posting, and a term moves once for many."""
    monkeypatch.setattr(lists, "LIST_SIZE", 10)
    monkeypatch.setattr(lists, "cut_lineage", None)
    lines = spark.range(0, 5000, 1, 4).selectExpr("string(id) AS doc", "0 AS line_no", "concat('the of the ', id % 7) AS line")
    for granularity in ("document", "record"):
        indexed = index.inverted_index(lines, granularity, size=100)
        assert indexed.where("term = 'the'").count() == 50
        plan = indexed._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "Generate posexplode" not in plan
    edges = spark.range(5000).selectExpr("'hot' AS src", "string(id) AS dst")
    assert graph.adjacency(edges, size=100).count() == 50


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_adjacency(spark, tiny, distinct, size):
    rng = random.Random(size)
    edges = [(rng.choice(["hot", "hot", "hot", "s1", "s2", None]), rng.choice(["t", f"t{rng.randrange(80)}", None])) for _ in range(900)]
    df = spark.createDataFrame(edges, "src string, dst string").repartition(5)
    found = graph.adjacency(df, distinct, size).collect()
    of = {}
    for src, dst in set(edges) if distinct else edges:
        of.setdefault(src, []).append(dst)
    want = {
        (src, s // size): (len(out), sorted(out, key=lambda d: (d is not None, d or ""))[s : s + size])
        for src, out in of.items() for s in range(0, len(out), size)
    }
    assert {(r.src, r.segment): (r.degree, r.out) for r in found} == want and len(found) == len(want)


def test_other_keys_are_listed_as_before(spark):
    edges = spark.createDataFrame([(1, 10), (1, 9), (1, 10), (2, 3)], "src int, dst int")
    assert sorted((r.src, r.degree, r.out) for r in graph.adjacency(edges).collect()) == [(1, 3, [9, 10, 10]), (2, 1, [3])]
    corpus = spark.createDataFrame([(10, 0, "x"), (9, 0, "x")], "doc int, line_no int, line string")
    assert [p.doc for p in index.inverted_index(corpus).select(F.inline("postings")).collect()] == [9, 10]


def test_lines_end_alike_however_they_end(spark):
    """As a text file would be read; no regular expression runs over whole texts."""
    texts = ["", "\n", "\r\n", "\r", "a", "a\n", "a\r\n", "a\r\r\n", "a\n\r", "a\n\r\n", "\n\n", "\r\r", "\r\n\r\n",
             "a\r\nb\rc\nd", "é\r\n ü \x0b x\f\t y ", " ", "a b\u0085c d\n"]
    found = spark.createDataFrame(enumerate(texts), "id int, text string").select("id", split_lines("text").alias("x"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan

    def plain(text):
        cut = re.split(r"\r\n|\n|\r", text)
        return (cut[:-1] if cut[-1] == "" else cut) if text else None

    assert {r.id: r.x for r in found.collect()} == {i: plain(t) for i, t in enumerate(texts)}
