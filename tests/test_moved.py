"""What a job moves: lines instead of terms, and few pieces in a round of PageRank."""

from pyspark.sql import functions as F

from sparrowmill.operators import counts, graph
from sparrowmill.session import shuffled_into
from sparrowmill.sources.text import corpus_lines


def test_lines_travel_instead_of_their_terms(spark):
    texts = [("d1", "a b a\n\nb"), ("d1", "a c"), (None, "x x"), (None, "x")]
    lines = corpus_lines(spark.createDataFrame(texts, "id string, text string"), "id", "text")
    tf = counts.term_frequency(lines, "record")
    # Lines of equal names count together.
    assert sorted(map(tuple, tf.collect()), key=str) == sorted(
        [("d1", 0, "a", 3), ("d1", 0, "b", 1), ("d1", 0, "c", 1), ("d1", 2, "b", 1), (None, 0, "x", 3)], key=str
    )
    plan = counts.term_frequency(lines, "record")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning(doc")


def test_partitions_of_pagerank_follow_the_cores(spark, monkeypatch):
    """A round writes partitions times partitions pieces: many shuffle partitions on few cores do not multiply them."""
    monkeypatch.setattr(graph, "FEWEST_LINKS", 1)
    seen, plain = [], graph._layout
    monkeypatch.setattr(graph, "_layout", lambda links, pages: seen.append(pages.partitions) or plain(links, pages))
    edges = spark.range(2000).select(
        F.concat(F.lit("a"), F.col("id") % 100).alias("src"), F.concat(F.lit("a"), F.col("id") % 97).alias("dst")
    )
    with shuffled_into(spark, 200):
        got = graph.pagerank(edges, 2).count()
    assert got == 100 and seen == [2 * spark.sparkContext.defaultParallelism]
