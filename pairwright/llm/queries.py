"""Registered queries of this package and, where SQL can say it, their oracle."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from . import ann, bpe, codes, dialogue, fingerprints, idfiles, packing, pii, quality, setjoin, simhash, tokens, toxicity, warc
from .common import read

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    return tokens.read_file(public_tokenizers.path(name))


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op2_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_read(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(WORD_TOKENIZER))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    scored = quality.score_documents(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= quality.KEEP_SCORE).alias("keep"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.link_documents(read(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=90)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.write_and_read(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(WORD_TOKENIZER))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(BYTE_TOKENIZER))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_damaged(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours,
        op2_web_archives,
        op3_personal_data,
        op4_packing,
        op5_quality,
        op6_toxicity,
        op7_fingerprints,
        op8_ngram_jaccard_join,
        op9_token_files,
        op10_bpe_round_trip,
        op11_simhash,
        op12_conversation_repair,
        op13_vector_codes,
    )
} | {"pipeline": corpus_pipeline.run}


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Product codebooks by plain comparison of every part with every entry."""
    # Sums of products of whole numbers are exact in doubles of this size.
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT p, vec_id, any_value(w) AS w, min({{'d': ww - 2 * list_dot_product(w, c) + cc, 'e': e}}) AS best
  FROM parts JOIN (SELECT *, list_dot_product(c, c) AS cc FROM b{i}) USING (p) GROUP BY p, vec_id)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT p, e, list(x ORDER BY pos) AS moved FROM (
    SELECT p, e, pos, floor(sum(x) / count(*)) AS x
    FROM (SELECT p, best.e AS e, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM a{i}) GROUP BY p, e, pos)
  GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(moved, c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS nth,
         list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, nth, p, w, list_dot_product(w, w) AS ww
  FROM (SELECT vec_id, nth, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS w FROM kept, range({parts}) AS r(p))),
b0 AS MATERIALIZED (SELECT p, nth AS e, w AS c FROM parts WHERE nth < {entries}),{",".join(steps)},
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, pos)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS pos FROM b{rounds})),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN embeddings USING (vec_id), digest"""


ORACLES = {
    "op13_vector_codes": _codes_sql(codes.PARTS, codes.ENTRIES, codes.ROUNDS, codes.SCALE),
    "op2_web_archives": """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
      FROM pages)""",
}
