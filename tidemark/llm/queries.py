"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, codes, decontaminate, html_extract, lm_score, paragraphs, quality, setsketch, simhash, suffix_dedup, token_counts, topk, viterbi,
)
from .common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

ACCEPT = 0.7  # a document is predicted good from this score up


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("key")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_and_back(table(spark, sf_dir, "documents"))


def pieces_and_back(docs: DataFrame) -> DataFrame:
    """Encodes every text and decodes it again: (doc_id, n_tokens, score, ids_hash, round_trip)."""
    return viterbi.encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "score", F.xxhash64("ids").alias("ids_hash"),
        (F.col("back") == F.col("key")).alias("round_trip"),
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + (x.stop - x.start))
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.col("kept").alias("kept_sha256"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op10_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_removed", "first_docs", "text")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode(table(spark, sf_dir, "embeddings"))


def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score and predicted; learns from labelled rows that are not held out."""
    known = labels.where(~held_out("doc_id", 4)).select("doc_id", F.col("quality").alias("label"))
    model = quality.train(docs.where(~held_out("doc_id", 4)), known)
    return quality.score(docs.withColumn("held_out", held_out("doc_id", 4)), model).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_token_counts": op2_token_counts,
    "op3_decontaminate": op3_decontaminate,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_lm_score": op5_lm_score,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_html": op7_html,
    "op8_topk": op8_topk,
    "op9_quality": op9_quality,
    "op10_paragraphs": op10_paragraphs,
    "op11_alignment": op11_alignment,
    "op12_codes": op12_codes,
    "op13_setsketch": op13_setsketch,
}

def codes_sql() -> str:
    """k-means in SQL: one pair of steps per round, every distance in full."""
    steps = ["""
        v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS r, vec_id, label, e, len(e) // 8 AS w FROM (
                SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS e
                FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        ), p AS MATERIALIZED (
            SELECT r, i AS part, list_slice(e, i * w + 1, i * w + w) AS x FROM v, range(8) t(i)
        ), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 16)"""]
    for n in range(codes.ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
            SELECT r, part, min((d, entry)) AS best FROM (
                SELECT r, p.part, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT)))::BIGINT AS d
                FROM p JOIN b{n} b ON b.part = p.part) GROUP BY r, part)""")
        if n < codes.ROUNDS:
            steps.append(f"""m{n} AS MATERIALIZED (
                SELECT part, entry, list(CAST(floor(s / c) AS BIGINT) ORDER BY i) AS x FROM (
                    SELECT p.part, best[2] AS entry, i, sum(x[i + 1])::DOUBLE AS s, count(*) AS c
                    FROM p JOIN a{n} a ON a.r = p.r AND a.part = p.part, range(len(x)) t(i) GROUP BY ALL) GROUP BY part, entry),
            b{n + 1} AS MATERIALIZED (
                SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{n} b LEFT JOIN m{n} m ON m.part = b.part AND m.entry = b.entry)""")
    last = codes.ROUNDS
    steps.append(f"""f AS (
            SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{last} GROUP BY r
        ), h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{last})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM v JOIN f USING (r), h""")
    return "WITH " + ",\n".join(steps[:-1]) + ",\n" + steps[-1]


ORACLE: dict[str, str] = {
    "op12_codes": codes_sql(),
    "op8_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op13_setsketch": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
        ), n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
        u AS (SELECT doc_id, unnest(s) AS x FROM s),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
        r AS (SELECT doc_id, doc_id AS to_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.to_id),
        m AS (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)
    """,
}
