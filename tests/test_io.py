"""Text sinks, side tables, the shared folder."""

import gc
import os
import time

import pytest

import __spark_entry__ as contract
from sparrowmill import session
from sparrowmill.operators import index
from sparrowmill.sources import records, sinks
from sparrowmill.sources.text import corpus_lines, read_documents, read_lines, read_table


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame([("a", 2), ("b", 10)], "term string, n bigint")


def values(spark, path):
    return sorted(r.value for r in read_lines(spark, path).collect())


def test_key_value_sink(spark, counts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_kv(counts, path, "term", "n")
    assert values(spark, path) == ["a\t2", "b\t10"]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.write_kv(counts, path, "term", "n")
    sinks.write_kv(counts.limit(1), path, "term", "n", mode="overwrite")
    assert len(values(spark, path)) == 1


def test_tuple_sink(spark, counts, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tuples(counts, path, "term", "n")
    assert values(spark, path) == ["(a,2)", "(b,10)"]


def test_side_table(spark):
    lines = spark.createDataFrame([("a\t2",), ("b 10 ",), ("x y z",), ("lone",), (" lead 3",)], "value string")
    assert {tuple(r) for r in records.read_counts(lines).collect()} == {("a", 2), ("b", 10)}
    assert {r.value for r in records.count_rejects(lines).collect()} == {"x y z", "lone", " lead 3"}
    with pytest.raises(Exception, match="bad count"):
        records.read_counts(spark.createDataFrame([("a b",)], "value string")).collect()


def test_table_columns_and_spread(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(100).selectExpr("id", "id AS a", "id AS b").coalesce(1).write.parquet(path)
    df = read_table(spark, path, ["id", "a"], "id")
    assert df.columns == ["id", "a"] and df.count() == 100
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "ReadSchema: struct<id:bigint,a:bigint>" in df._jdf.queryExecution().toString()


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(session.CHECKPOINT_DIR)
    assert session.shared_dir(spark) == folder
    assert session.scratch_path(spark, "x").startswith(folder)


def test_documents_keep_their_names(spark, tmp_path):
    path = str(tmp_path / "documents")
    rows = [("a/b 1.txt", "x y\n\ny"), ("007", "y"), ("é=%", "x x")]
    sinks.write_documents(corpus_lines(spark.createDataFrame(rows, "id string, text string"), "id", "text"), path)
    back = read_documents(spark, path)
    lines = {}
    for r in back.orderBy("doc", "line_no").collect():
        lines.setdefault(r.doc, []).append(r.line)
    assert lines == {"a/b 1.txt": ["x y", "", "y"], "007": ["y"], "é=%": ["x x"]}
    got = {r.term: [tuple(p) for p in r.postings] for r in index.inverted_index(back).collect()}
    assert got == {"x": [("a/b 1.txt", 1), ("é=%", 2)], "y": [("007", 1), ("a/b 1.txt", 2)]}


def test_folders_are_listed_many_to_a_task(spark, tmp_path):
    path, context = str(tmp_path / "many"), spark.sparkContext
    lines = spark.range(60).selectExpr("concat('d', id) AS doc", "0 AS line_no", "'x' AS line")
    sinks.write_documents(lines, path)
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    context.setJobGroup("listing", "listing")
    try:
        back = read_documents(spark, path)
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= 2 * context.defaultParallelism < 60
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert back.select("doc").distinct().count() == 60


def files_under(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names]


def test_scratch_goes_on_failure_too(spark):
    with pytest.raises(ZeroDivisionError), session.scratch(spark, "t") as path:
        spark.range(3).write.parquet(path)
        assert files_under(path)
        1 / 0
    assert not os.path.exists(path)
    session.drop_path(spark, path)


@pytest.mark.skipif(not os.path.isdir(contract.SMOKE_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["index_of_documents", "tuples_from_files", "pagerank_multi", "inverted_index_segments"])
def test_no_files_are_left(spark, name):
    """Once nobody holds a result, nothing of the query lies in the shared folder."""
    folder = session.shared_dir(spark)
    before = set(files_under(folder))
    result = contract.queries()[name](spark, contract.SMOKE_DIR)
    assert result.count() > 0
    del result
    for _ in range(60):
        gc.collect()
        spark._jvm.System.gc()
        left = set(files_under(folder)) - before
        if not left:
            break
        time.sleep(0.5)
    assert not left
