"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, paragraphs, queries, simhash, viterbi
from tidemark.llm.common import stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts."""
    return queries.graded(docs, table(spark, sf_dir, "labels")).where(F.col("predicted") == 1).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the SimHash operator links: the one with the smallest id."""
    return simhash.one_of_each(docs).select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; a document of nothing else goes."""
    kept = paragraphs.dedup(docs).where("n_removed = 0 OR text <> ''")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    return viterbi.encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("back") == F.col("key")).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Trained weights, fingerprints and segmentations are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
