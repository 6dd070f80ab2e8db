"""Hot keys, long lists and long lines give the same result as the plain form."""

import random

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import counts, index, lists, pairs, skew
from sparrowmill.sources.text import corpus_lines

MODES = ["docfreq", "positional"]


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of all words is one word; one line is far longer than the others."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)]

    def line(n):
        return " ".join("hot" if rng.random() < 0.33 else rng.choice(vocabulary) for _ in range(n))

    texts = [(i, "\n".join(line(rng.randint(0, 12)) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    texts.append((60, line(150)))
    return corpus_lines(spark.createDataFrame(texts, "id bigint, text string"), "id", "text").persist()


def brute_force(corpus, mode):
    together = {}
    for r in counts.tokenized(corpus).collect():
        words = sorted(set(r.tokens)) if mode == "docfreq" else r.tokens
        for i, left in enumerate(words):
            for right in words[i + 1 :]:
                together[left, right] = together.get((left, right), 0) + 1
    return together


def as_dict(df):
    rows = df.collect()
    got = {(r.left, r.right): r.pair_count for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("min_count", [1, 5, 30])
def test_pairs_and_pruning(corpus, mode, min_count):
    want = {p: c for p, c in brute_force(corpus, mode).items() if c >= min_count}
    assert as_dict(pairs.cooccurrence(corpus, mode, min_count, chunk=16)) == want


@pytest.mark.parametrize("mode", MODES)
def test_pruning_leaves_terms_out(corpus, mode):
    records = counts.tokenized(corpus)
    assert pairs.vocabulary(records, mode, 30).rows.count() < pairs.vocabulary(records, mode, 1).rows.count()


@pytest.mark.parametrize("mode", MODES)
def test_wide_ids_and_salted_joins(corpus, mode, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(pairs, "NARROW_TERMS", 0)
    records = counts.tokenized(corpus)
    vocab = pairs.vocabulary(records, mode)
    assert not vocab.packable
    assert as_dict(pairs._counted(records, vocab, mode, 1, 16)) == brute_force(corpus, mode)


def test_terms_that_share_a_hash(spark, monkeypatch):
    """Few bits leave collisions under most seeds; one without is found, or the wide hash is taken."""
    terms = spark.range(12).select(F.concat(F.lit("t"), "id").alias("term"))
    monkeypatch.setattr(pairs, "NARROW_BITS", 7)
    seed, narrow = pairs._numbering(terms, 12)
    assert narrow and terms.select(pairs._term_id("term", seed, narrow)).distinct().count() == 12
    monkeypatch.setattr(pairs, "NARROW_BITS", 3)
    assert pairs._numbering(terms, 12) == (0, None)


@pytest.mark.parametrize("mode", MODES)
def test_passes_over_the_units(corpus, mode, monkeypatch):
    monkeypatch.setattr(pairs, "MOST_TASKS", 2)
    monkeypatch.setattr(pairs, "PAIRS_PER_TASK", 500)
    records = counts.tokenized(corpus)
    vocab = pairs.vocabulary(records, mode)
    assert pairs._tasks_and_passes(vocab.n_pairs, 8)[1] > 1
    assert as_dict(pairs._counted(records, vocab, mode, 1, 16)) == brute_force(corpus, mode)


def test_tasks_follow_the_pairs(corpus):
    vocab = pairs.vocabulary(counts.tokenized(corpus), "positional")
    assert vocab.n_pairs == sum(brute_force(corpus, "positional").values())
    assert vocab.n_records == corpus.count()
    asked = (0, 250_000, 10_000_000, 10**9, 10**15)
    assert [pairs._tasks_and_passes(n, 8) for n in asked] == [(1, 1), (3, 1), (8, 1), (251, 1), (19_999, 12_501)]


def test_short_records_do_not_move(spark):
    """Pairs of short records reach their count without a shuffle of records, terms or units."""
    lines = corpus_lines(spark.range(50).selectExpr("id", "concat('a b ', id, ' c') AS text"), "id", "text")
    records = counts.tokenized(lines)
    vocab = pairs.vocabulary(records, "docfreq")
    plan = pairs._added(pairs._pairs_in_place(pairs._coded(records, vocab, "docfreq")), vocab, "docfreq")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_names_are_salted_by_kept_pairs(spark, monkeypatch):
    """A term that occurs once, in a record with very many others, has many pairs and few occurrences."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    seen, plain = [], pairs.salted_join

    def spied(rows, dim, key, weight, spread_by):
        seen.append({r.term: r["__salts"] for r in (
            dim.withColumnRenamed("left" if key == "l" else "right", "term")
            .withColumn("__key_hash", F.xxhash64(key))
            .join(skew.salt_counts(dim, key, weight, 8), "__key_hash").collect()
        )})
        return plain(rows, dim, key, weight, spread_by)

    monkeypatch.setattr(pairs, "salted_join", spied)
    texts = [(0, "rare " + " ".join(f"x{i}" for i in range(200)))] + [(i, "often often") for i in range(1, 300)]
    df = corpus_lines(spark.createDataFrame(texts, "id bigint, text string"), "id", "text")
    # Only pairs with the rare term are kept.
    vocab = pairs.vocabulary(counts.tokenized(df), "positional")
    kept = pairs._pair_counts(counts.tokenized(df), vocab, "positional", 512)
    kept = kept.join(vocab.rows.where("term = 'rare'").select(F.col("id").alias("l")), "l")
    named = pairs._named(kept, vocab, "positional")
    assert named.count() == 200 and {r.left for r in named.collect()} == {"rare"}
    assert seen[0] == {"rare": 8} and seen[1] == {}


def test_hot_keys_are_salted(spark):
    dim = spark.createDataFrame([("hot", 900)] + [(f"k{i}", 1) for i in range(100)], "k string, n int")
    salts = skew.salt_counts(dim, "k", "n", 8).collect()
    assert [r["__salts"] for r in salts] == [8]
    rows = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("k"), F.col("id") - 900)).alias("k"), "id"
    )
    joined = skew.salted_join(rows, dim, "k", "n", ["id"])
    assert joined.columns == ["k", "id", "n"]
    assert joined.count() == 1000 and joined.select("id").distinct().count() == 1000
    assert joined.where("(k = 'hot') != (n = 900)").count() == 0
    part = dim.where("k != 'k7'")
    left = skew.salted_join(rows, part, "k", "n", ["id"], "left")
    assert left.count() == 1000 and left.where("n IS NULL").select("k").first().k == "k7"


def plain_lists(rows, size):
    lists_of = {}
    for key, item, copies in sorted(rows):
        lists_of.setdefault(key, []).extend([item] * copies)
    return {
        (key, s // size): (len(items), items[s : s + size])
        for key, items in lists_of.items()
        for s in range(0, len(items), size)
    }


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
@pytest.mark.parametrize("broadcast_bytes", [-1, 64 << 20])
def test_bounded_lists(spark, monkeypatch, size, broadcast_bytes):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast_bytes)
    rng = random.Random(size)
    rows = [("hot", f"d{i:04}", rng.choice([1, 1, 2, 30])) for i in range(400)]
    rows += [(f"k{i}", f"d{j:04}", rng.choice([1, 3])) for i in range(20) for j in rng.sample(range(400), 9)]
    df = spark.createDataFrame(rows, "k string, item string, n int").repartition(5)
    got = {
        (r.k, r.segment): (r.total, [i["item"] for i in r["items"]])
        for r in lists.bounded_lists(df, "k", ["item"], ["item"], "n", size).collect()
    }
    assert got == plain_lists(rows, size)


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
@pytest.mark.parametrize("copies", ["n", None])
def test_lists_over_many_tasks(spark, monkeypatch, size, copies):
    """Keys beyond one task's room are cut into the same segments, from runs of any length."""
    monkeypatch.setattr(lists, "LIST_SIZE", 20)
    monkeypatch.setattr(lists, "RUN_ROWS", 30)
    rng = random.Random(size)
    rows = [(k, f"d{rng.randrange(300):04}", rng.choice([1, 1, 2, 30]) if copies else 1) for k in "ab" for _ in range(400)]
    rows += [(f"k{i}", f"d{j:04}", 1) for i in range(20) for j in rng.sample(range(400), 9)]
    df = spark.createDataFrame(rows, "k string, item string, n int").repartition(5)
    found = lists.bounded_lists(df, "k", ["item"], ["item"], copies, size).collect()
    got = {(r.k, r.segment): (r.total, [i["item"] for i in r["items"]]) for r in found}
    assert len(found) == len(got) and got == plain_lists(rows, size)


def test_lists_of_one_task_are_not_stored(spark, monkeypatch):
    """Short segments alone do not make a key large: nothing is range-partitioned, and rows travel once."""
    monkeypatch.setattr(lists, "_stored", None)
    df = spark.range(3000).selectExpr("id % 3 AS k", "id AS item")
    cut = lists.bounded_lists(df, "k", ["item"], ["item"], None, 100)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and cut.count() == 30


def test_record_index_adds_up_to_document_index(corpus):
    def summed(granularity, size):
        df = index.inverted_index(corpus, granularity, size=size)
        rows = df.select("term", F.inline("postings")).groupBy("term", "doc").agg(F.sum("tf").alias("tf"))
        return {tuple(r) for r in rows.collect()}

    assert summed("record", 10) == summed("document", 100_000) == summed("document", 10)


def test_index_ignores_partitioning(corpus):
    def rendered(df):
        return sorted(map(tuple, index.render_index(index.inverted_index(df, "record", size=25)).collect()))

    assert rendered(corpus) == rendered(corpus.repartition(13))


def test_stripes_equal_pairs(corpus):
    want = as_dict(pairs.cooccurrence(corpus, "positional"))
    for size in (5, 100_000):
        got = pairs.explode_stripes(pairs.stripes(corpus, size=size), "pair_count")
        assert as_dict(got) == want


def test_pmi_with_and_without_pruning(corpus):
    def scores(min_count):
        return {
            (r.left, r.right): round(r.pmi, 9)
            for r in pairs.pmi(corpus, "docfreq", min_count=min_count).collect()
            if r.pair_count >= 5
        }

    assert scores(1) == scores(5)
