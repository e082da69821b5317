"""A corpus pipeline in stages: toxicity, quality, near duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.

Defined results for all stages: an empty table gives an empty one; a missing text counts
as an empty one and stays missing where texts are kept; other columns are carried along
and may hold nulls; rows that are equal in all columns meet the same decision. What a stage
does with ties and repeated or missing ids is said there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairwright.llm import packing, pii, quality, setjoin, tokens, toxicity
from pairwright.llm.common import read
from pairwright.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; ids and their repetition play no part in it."""
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.reject(docs, toxicity.fit(docs.select("doc_id", "text"), labels))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of sufficient quality for their site, a score of exactly the threshold included.

    Documents without a source are one site.
    """
    scored = quality.score(
        docs, quality.fit(docs, read(spark, sf_dir, "labels")), F.col("source"), F.col("lang"), "_score"
    )
    return scored.where(F.col("_score") >= quality.KEEP_SCORE).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near duplicates (five-word shingles, similarity 0.8).

    Of rows with one id one stays; rows without an id stay, as no group can be named by them.
    """
    linked = setjoin.link_documents(docs.select("doc_id", "text"))
    kept = materialize(linked.where("doc_id = component_id").select("doc_id").distinct())
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; the length follows the text and is missing with it."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their training sequences; repeated rows are packed each on their own."""
    vocabulary = tokens.read_file(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(docs.select("doc_id", "text"), vocabulary)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# Learned models, tokenizers and leaders of groups are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
