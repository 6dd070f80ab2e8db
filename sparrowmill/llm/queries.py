"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bands, bpe_stream, classifier, cover_codes, fingerprints, fmindex, hard_negatives, jaccard, packing, pseudo, repair,
    suffix_dedup, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.quality_rules(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = classifier.train(docs, _table(spark, sf_dir, "labels"))
    return classifier.score(docs, model)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.token_files(_table(spark, sf_dir, "documents"))


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.substring_dedup(_table(spark, sf_dir, "documents"))


def op10_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.encode_decode(_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(
        _table(spark, sf_dir, "embeddings"), label=hard_negatives.planted_labels(), is_anchor=F.col("vec_id") % 50 == 0
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_fingerprints,
        op3_quality_rules,
        op4_warc,
        op5_quality_classifier,
        op6_token_files,
        op7_pseudo_likelihood,
        op8_packing,
        op9_substring_dedup,
        op10_streaming_bpe,
        op11_suffix_dedup,
        op12_hard_negatives,
        op13_vector_codes,
    )
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_WHOLE = """kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )"""


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """Assignments and codebooks by brute force, a pair of tables for each round."""
    gap = "list_sum(list_transform(list_zip(c.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"WITH {_WHOLE}",
        f"""cut AS MATERIALIZED (
            SELECT n, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
            FROM (SELECT v, row_number() OVER (ORDER BY vec_id, v) AS n FROM kept), range({parts}) AS t(p)
        ), b0 AS MATERIALIZED (SELECT p, n - 1 AS e, x FROM cut WHERE n <= {entries})""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
            SELECT n, p, any_value(x) AS x, min(gap).e AS e, min(gap).d AS d
            FROM (SELECT c.n, c.p, c.x, {{'d': {gap}, 'e': b.e}} AS gap FROM cut c JOIN b{k} b ON b.p = c.p) GROUP BY n, p
        )""")
        if k < rounds:
            steps.append(f"""mean{k} AS (
            SELECT p, e, list(m ORDER BY i) AS x FROM (
                SELECT p, e, i, floor(sum(y) / count(*))::BIGINT AS m
                FROM (SELECT p, e, unnest(range(len(x))) AS i, unnest(x) AS y FROM near{k}) GROUP BY p, e, i
            ) GROUP BY p, e
        ), b{k + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e
        )""")
    last = f"near{rounds}"
    return ",\n".join(steps) + f""", coded AS (
            SELECT n, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM {last} GROUP BY n
        ), books AS (
            SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}
        ), named AS (
            SELECT vec_id, label, code, error
            FROM coded JOIN (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, v) AS n FROM kept) USING (n)
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM named, books
    """


# SQL for the same rows, where SQL can express them.
SQL: dict[str, str] = {
    "op1_jaccard_join": rf"""
        WITH RECURSIVE split AS (
            SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
            FROM documents
        ), tokens AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS token
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM split WHERE len(ws) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
        )
        SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id
        GROUP BY d.doc_id
    """,
    "op4_warc": """
        WITH sized AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), digested AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM sized
        ), marked AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS target FROM digested
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> target THEN target END AS refers_to
        FROM marked
    """,
    "op9_substring_dedup": rf"""
        WITH split AS (
            SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
        ), places AS (
            SELECT doc_id, i, array_to_string(ws[i : i + 34], ' ') AS win
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM split WHERE len(ws) >= 35)
        ), repeated AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM places) WHERE n > 1
        ), covered AS (
            SELECT DISTINCT doc_id, i + j AS at FROM repeated, range(0, 35) AS t(j)
        ), words AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS at FROM split
        ), kept AS (
            SELECT w.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY w.at) AS text
            FROM words w ANTI JOIN covered c ON c.doc_id = w.doc_id AND c.at = w.at GROUP BY w.doc_id
        )
        SELECT s.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
    """,
    "op12_hard_negatives": f"""
        WITH {_WHOLE}, labelled AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
            FROM kept WHERE vec_id IS NOT NULL AND label IS NOT NULL
        ), scored AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM labelled a JOIN labelled b ON a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, id, score FROM scored WHERE alike AND id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, p.id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
        WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
    "op13_vector_codes": _codes_sql(16, 64, 2),
}
