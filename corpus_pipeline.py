"""From raw documents to packed training sequences: quality, toxicity, line and near-duplicate removal, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm.common import cut, table
from sentrylake.llm.linededup import line_dedup
from sentrylake.llm.minhash import one_of_each
from sentrylake.llm.packing import pack_documents
from sentrylake.llm.quality import quality_rules
from sentrylake.llm.tokens import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that fail."""
    kept = quality_rules(docs).where("kept")
    return kept.withColumns({"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}).select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit; labels are learned from the documents at hand."""
    from sentrylake.llm.toxicity import toxicity_scores

    return toxicity_scores(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; those of which nothing is left go."""
    left = line_dedup(docs)
    left = left.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group. Rows that share an id but not the text are documents of their own."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary_path("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("minhash_near_dedup", near),
    ("best_fit_packing", packing),
]

# Packing and the learned stage cannot be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
