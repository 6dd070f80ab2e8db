"""Counts, pairs, PMI and indexes over ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.render import postings_text
from ..functions.text import sorted_terms
from ..operators import counts, index, pairs
from ..session import cut_lineage, scratch
from ..sources import records, sinks
from ..sources.text import corpus_lines, read_corpus, read_documents, read_lines, read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text"], "doc_id")
    return corpus_lines(table, "doc_id", "text")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, f"{sf_dir}/conversations.parquet", ["conv_id", "turn", "text"], "conv_id")
    keyed = table.select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    return corpus_lines(keyed, "id", "text")


def _rounded(pmi: DataFrame) -> DataFrame:
    return pmi.withColumn("pmi", F.round("pmi", 6))


# -- counts -----------------------------------------------------------------


def word_count(spark, sf_dir):
    return counts.word_count(counts.tokenized(documents(spark, sf_dir)))


def doc_frequency(spark, sf_dir):
    return counts.doc_frequency(counts.tokenized(documents(spark, sf_dir)))


def term_frequency(spark, sf_dir):
    return counts.term_frequency(documents(spark, sf_dir))


def term_frequency_record(spark, sf_dir):
    return counts.term_frequency(documents(spark, sf_dir), "record")


def record_terms(spark, sf_dir):
    """The sorted distinct terms of each line, as one text."""
    records = counts.tokenized(documents(spark, sf_dir))
    return records.select("doc", "line_no", F.array_join(sorted_terms("tokens"), " ").alias("terms"))


# -- pairs and PMI ----------------------------------------------------------


def _pairs_by_left(counted: DataFrame) -> DataFrame:
    """Per left term, sums to which every pair adds."""
    return counted.groupBy("left").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum("pair_count").alias("n_together"), F.max("pair_count").alias("most")
    )


def cooccur_docfreq(spark, sf_dir):
    return _pairs_by_left(pairs.cooccurrence(documents(spark, sf_dir), "docfreq"))


def cooccur_positional(spark, sf_dir):
    return _pairs_by_left(pairs.cooccurrence(documents(spark, sf_dir), "positional"))


def cooccur_rows(spark, sf_dir):
    return pairs.cooccurrence(conversations(spark, sf_dir), "docfreq")


# The threshold is the feature here.
def cooccur_frequent(spark, sf_dir):
    return pairs.cooccurrence(documents(spark, sf_dir), "docfreq", min_count=20)


def pmi_docfreq(spark, sf_dir):
    return _rounded(pairs.pmi(conversations(spark, sf_dir), "docfreq"))


def pmi_positional(spark, sf_dir):
    return _rounded(pairs.pmi(conversations(spark, sf_dir), "positional"))


def pmi_n100(spark, sf_dir):
    return _rounded(pairs.pmi(conversations(spark, sf_dir), "docfreq", n_docs=100))


def _by_left(pmi: DataFrame) -> DataFrame:
    """Per left term, a summary of all of its pairs: every pair adds its PMI, in whole millionths."""
    return pmi.groupBy("left").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum("pair_count").alias("n_together"),
        F.sum(F.round(F.col("pmi") * 1e6).cast("bigint")).alias("sum_pmi"),
        F.round(F.min("pmi"), 6).alias("min_pmi"),
        F.round(F.max("pmi"), 6).alias("max_pmi"),
    )


def pmi_docfreq_all(spark, sf_dir):
    return _by_left(pairs.pmi(documents(spark, sf_dir), "docfreq"))


def pmi_positional_all(spark, sf_dir):
    return _by_left(pairs.pmi(documents(spark, sf_dir), "positional"))


def pmi_n100_all(spark, sf_dir):
    return _by_left(pairs.pmi(documents(spark, sf_dir), "docfreq", n_docs=100))


def pmi_stripes(spark, sf_dir):
    striped = pairs.pmi_stripes(conversations(spark, sf_dir))
    return _rounded(pairs.explode_stripes(striped, "pmi"))


def stripes(spark, sf_dir):
    striped = pairs.stripes(conversations(spark, sf_dir))
    return pairs.explode_stripes(striped, "pair_count")


# Small segments, so that frequent left terms have several.
def stripe_segments(spark, sf_dir):
    striped = pairs.stripes(conversations(spark, sf_dir), size=100)
    return striped.select("left", "segment", F.array_join(F.array_sort(F.map_keys("stripe")), " ").alias("partners"))


# -- inverted index ---------------------------------------------------------


def _as_text(indexed: DataFrame) -> DataFrame:
    return indexed.select("term", "df", "segment", postings_text("postings").alias("postings"))


def inverted_index_document(spark, sf_dir):
    return _as_text(index.inverted_index(documents(spark, sf_dir)))


def inverted_index_record(spark, sf_dir):
    return _as_text(index.inverted_index(documents(spark, sf_dir), "record", keep_empty=True))


# Small segments, so that frequent terms have several.
def inverted_index_segments(spark, sf_dir):
    return _as_text(index.inverted_index(documents(spark, sf_dir), "record", size=100))


def index_rendered(spark, sf_dir):
    return index.render_index(index.inverted_index(documents(spark, sf_dir), "record", order="text"))


# -- sources and sinks ------------------------------------------------------

# What is read back is stored once more before its files go.


def lines_from_files(spark, sf_dir):
    with scratch(spark, "lines") as path:
        documents(spark, sf_dir).select(F.col("line").alias("value")).write.mode("overwrite").text(path)
        return cut_lineage(read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def counts_from_files(spark, sf_dir):
    with scratch(spark, "counts") as path:
        sinks.write_kv(word_count(spark, sf_dir), path, "term", "n", mode="overwrite")
        return cut_lineage(records.read_counts(read_lines(spark, path)))


# The second write replaces the first.
def tuples_from_files(spark, sf_dir):
    with scratch(spark, "tuples") as path:
        sinks.write_tuples(doc_frequency(spark, sf_dir), path, "term", "df")
        sinks.write_tuples(word_count(spark, sf_dir), path, "term", "n", mode="overwrite")
        return cut_lineage(read_lines(spark, path).select("value"))


# File names are Spark's own, so each term's postings are added up.
def index_from_files(spark, sf_dir):
    with scratch(spark, "corpus") as path:
        documents(spark, sf_dir).select(F.col("line").alias("value")).write.text(path)
        indexed = index.inverted_index(read_corpus(spark, path))
        counted = F.aggregate("postings", F.lit(0).cast("bigint"), lambda n, x: n + x["tf"])
        return cut_lineage(indexed.groupBy("term").agg(F.sum(counted).alias("n")))


def index_of_documents(spark, sf_dir):
    """The postings of an index over files, with the names of the files."""
    with scratch(spark, "documents") as path:
        lines = documents(spark, sf_dir)
        sinks.write_documents(lines.withColumn("doc", F.concat(F.lit("doc "), "doc", F.lit(".txt"))), path)
        indexed = index.inverted_index(read_documents(spark, path))
        return cut_lineage(
            indexed.select("term", F.inline("postings")).select("term", F.col("doc").alias("file"), "tf")
        )


def pmi_from_files(spark, sf_dir):
    with scratch(spark, "pmi") as path:
        rendered = pairs.render_pairs(_rounded(pairs.pmi(conversations(spark, sf_dir), "docfreq")))
        sinks.write_kv(rendered, path, "key", "value", mode="overwrite")
        fields = F.split("value", "\t")
        return cut_lineage(
            read_lines(spark, path).select(fields[0].alias("pair"), fields[1].cast("double").alias("pmi"))
        )


def count_rejects(spark, sf_dir):
    lines = documents(spark, sf_dir).select(F.col("line").alias("value"))
    return records.count_rejects(lines).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        word_count, doc_frequency, term_frequency, term_frequency_record, record_terms,
        cooccur_docfreq, cooccur_positional, cooccur_rows, cooccur_frequent, pmi_docfreq, pmi_positional, pmi_n100,
        pmi_docfreq_all, pmi_positional_all, pmi_n100_all, pmi_stripes, stripes, stripe_segments,
        inverted_index_document, inverted_index_record, inverted_index_segments, index_rendered,
        lines_from_files, counts_from_files, tuples_from_files, index_from_files, index_of_documents,
        pmi_from_files, count_rejects,
    )
}

# -- the same in SQL --------------------------------------------------------

_LINES = r"""
lines AS (
  SELECT doc, unnest(range(len(x))) AS line_no, unnest(x) AS line
  FROM (SELECT {doc} AS doc,
               regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r') AS x
        FROM {table} WHERE text <> ''))"""
DOC_LINES = _LINES.format(doc="doc_id::VARCHAR", table="documents")
CONV_LINES = _LINES.format(doc="conv_id || '/' || turn", table="conversations")

_TOKENS = r"""
records AS MATERIALIZED (
  SELECT doc, line_no, list_filter(regexp_split_to_array(line, '[ \t\n\r\f]+'), lambda x: x <> '') AS tokens
  FROM lines),
words AS MATERIALIZED (
  SELECT doc, line_no, unnest(range(len(tokens))) AS pos, unnest(tokens) AS term FROM records),
seen AS MATERIALIZED (SELECT DISTINCT doc, line_no, term FROM words)"""

_DOCFREQ = """
totals AS (SELECT term, count(*) AS n FROM seen GROUP BY term),
pairs AS (
  SELECT a.term AS "left", b.term AS "right", count(*) AS pair_count
  FROM seen a JOIN seen b ON a.doc = b.doc AND a.line_no = b.line_no AND a.term < b.term
  GROUP BY ALL HAVING count(*) >= {min_count})"""

_POSITIONAL = """
totals AS (SELECT term, count(*) AS n FROM words GROUP BY term),
pairs AS (
  SELECT a.term AS "left", b.term AS "right", count(*) AS pair_count
  FROM words a JOIN words b ON a.doc = b.doc AND a.line_no = b.line_no AND a.pos < b.pos
  GROUP BY ALL HAVING count(*) >= {min_count})"""

_PMI = """
pmi AS (
  SELECT p."left", p."right", p.pair_count,
         ln(p.pair_count::DOUBLE * {n} / (l.n::DOUBLE * r.n::DOUBLE)) AS pmi
  FROM pairs p JOIN totals l ON p."left" = l.term JOIN totals r ON p."right" = r.term)"""
_ALL_LINES = "(SELECT count(*) FROM lines)"


def _pairs_sql(mode: str, min_count: int, lines: str = DOC_LINES) -> str:
    return f"WITH {lines},{_TOKENS},{mode.format(min_count=min_count)}"


def _pmi_sql(mode: str, min_count: int, n: str = _ALL_LINES, lines: str = DOC_LINES) -> str:
    return f"{_pairs_sql(mode, min_count, lines)},{_PMI.format(n=n)}"


_PAIR_ROWS = ' SELECT "left", "right", pair_count FROM pairs'
_PAIR_SUMS = """ SELECT "left", count(*) AS n_pairs, sum(pair_count)::BIGINT AS n_together, max(pair_count) AS most
  FROM pairs GROUP BY "left" """
_PMI_ROWS = ' SELECT "left", "right", pair_count, round(pmi, 6) AS pmi FROM pmi'
_LEFT_ROWS = """ SELECT "left", count(*) AS n_pairs, sum(pair_count)::BIGINT AS n_together,
  sum(round(pmi * 1e6)::BIGINT)::BIGINT AS sum_pmi,
  round(min(pmi), 6) AS min_pmi, round(max(pmi), 6) AS max_pmi FROM pmi GROUP BY "left" """

_WS_TERMS = r"""
terms AS (
  SELECT doc, line_no, unnest(list_filter(regexp_split_to_array(line, '[ \t\n\v\f\r]+'), lambda x: x <> '')) AS term
  FROM lines),
record_tf AS (SELECT doc, line_no, term, count(*) AS tf FROM terms GROUP BY ALL),
document_tf AS (SELECT doc, term, count(*) AS tf FROM terms GROUP BY ALL)"""

# The empty tokens of blank lines and leading whitespace are kept, trailing ones not.
_WS_TERMS_EMPTY = r"""
bare AS (
  SELECT doc, line_no, line, regexp_replace(line, '[ \t\n\v\f\r]+$', '') AS kept FROM lines),
terms AS (
  SELECT doc, line_no, unnest(regexp_split_to_array(kept, '[ \t\n\v\f\r]+')) AS term
  FROM bare WHERE kept <> '' OR line = ''),
record_tf AS (SELECT doc, line_no, term, count(*) AS tf FROM terms GROUP BY ALL)"""


def _index_sql(terms: str, tf: str, by: str, size: int) -> str:
    return f"""WITH {DOC_LINES},{terms},
placed AS (
  SELECT term, doc, tf, '(' || doc || ',' || tf || ')' AS posting,
         count(*) OVER (PARTITION BY term) AS df,
         (row_number() OVER (PARTITION BY term ORDER BY {by}) - 1) // {size} AS segment
  FROM (SELECT *, '(' || doc || ',' || tf || ')' AS posting FROM {tf}))
SELECT term, df, segment, string_agg(posting, '' ORDER BY {by}) AS postings
FROM placed GROUP BY term, df, segment"""


SQL = {
    "word_count": f"WITH {DOC_LINES},{_TOKENS} SELECT term, count(*) AS n FROM words GROUP BY term",
    "doc_frequency": f"WITH {DOC_LINES},{_TOKENS} SELECT term, count(*) AS df FROM seen GROUP BY term",
    "term_frequency": f"WITH {DOC_LINES},{_WS_TERMS} SELECT doc, term, tf FROM document_tf",
    "term_frequency_record": f"WITH {DOC_LINES},{_WS_TERMS} SELECT doc, line_no::INTEGER AS line_no, term, tf FROM record_tf",
    "record_terms": f"""WITH {DOC_LINES},{_TOKENS}
SELECT doc, line_no::INTEGER AS line_no, array_to_string(list_sort(list_distinct(tokens)), ' ') AS terms FROM records""",
    "cooccur_docfreq": _pairs_sql(_DOCFREQ, 1) + _PAIR_SUMS,
    "cooccur_positional": _pairs_sql(_POSITIONAL, 1) + _PAIR_SUMS,
    "cooccur_rows": _pairs_sql(_DOCFREQ, 1, CONV_LINES) + _PAIR_ROWS,
    "cooccur_frequent": _pairs_sql(_DOCFREQ, 20) + _PAIR_ROWS,
    "pmi_docfreq": _pmi_sql(_DOCFREQ, 1, lines=CONV_LINES) + _PMI_ROWS,
    "pmi_positional": _pmi_sql(_POSITIONAL, 1, lines=CONV_LINES) + _PMI_ROWS,
    "pmi_n100": _pmi_sql(_DOCFREQ, 1, n="100", lines=CONV_LINES) + _PMI_ROWS,
    "pmi_docfreq_all": _pmi_sql(_DOCFREQ, 1) + _LEFT_ROWS,
    "pmi_positional_all": _pmi_sql(_POSITIONAL, 1) + _LEFT_ROWS,
    "pmi_n100_all": _pmi_sql(_DOCFREQ, 1, n="100") + _LEFT_ROWS,
    "pmi_stripes": _pmi_sql(_POSITIONAL, 1, lines=CONV_LINES) + ' SELECT "left", "right", round(pmi, 6) AS pmi FROM pmi',
    "stripes": _pairs_sql(_POSITIONAL, 1, CONV_LINES) + _PAIR_ROWS,
    "stripe_segments": _pairs_sql(_POSITIONAL, 1, CONV_LINES)
    + """ SELECT "left", segment, string_agg("right", ' ' ORDER BY "right") AS partners
          FROM (SELECT "left", "right", (row_number() OVER (PARTITION BY "left" ORDER BY "right") - 1) // 100 AS segment
                FROM pairs) GROUP BY "left", segment""",
    "inverted_index_document": _index_sql(_WS_TERMS, "document_tf", "doc, tf", 100_000),
    "inverted_index_record": _index_sql(_WS_TERMS_EMPTY, "record_tf", "doc, tf", 100_000),
    "inverted_index_segments": _index_sql(_WS_TERMS, "record_tf", "doc, tf", 100),
    "index_rendered": "SELECT term || ' ' || df AS \"key\", segment, postings AS \"value\" FROM ("
    + _index_sql(_WS_TERMS, "record_tf", "posting", 100_000) + ")",
    "lines_from_files": f"WITH {DOC_LINES} SELECT line AS \"value\", count(*) AS n FROM lines GROUP BY line",
    "counts_from_files": f"WITH {DOC_LINES},{_TOKENS} SELECT term, count(*) AS n FROM words GROUP BY term",
    "tuples_from_files": f"""WITH {DOC_LINES},{_TOKENS}
SELECT '(' || term || ',' || count(*) || ')' AS "value" FROM words GROUP BY term""",
    "index_from_files": f"""WITH {DOC_LINES},{_WS_TERMS} SELECT term, sum(tf)::BIGINT AS n FROM document_tf GROUP BY term""",
    "index_of_documents": f"""WITH {DOC_LINES},{_WS_TERMS}
SELECT term, 'doc ' || doc || '.txt' AS file, tf FROM document_tf""",
    "pmi_from_files": _pmi_sql(_DOCFREQ, 1, lines=CONV_LINES)
    + """ SELECT '(' || "left" || ',' || "right" || ')' AS pair, round(pmi, 6) AS pmi FROM pmi""",
    "count_rejects": rf"""WITH {DOC_LINES}
SELECT line AS "value", count(*) AS n FROM lines
WHERE len(regexp_split_to_array(regexp_replace(line, '[ \t\n\v\f\r]+$', ''), '[ \t\n\v\f\r]+')) <> 2
GROUP BY line""",
}
