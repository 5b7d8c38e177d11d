"""From raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept and returns those it keeps, with the columns of ``documents``;
the last returns sequences. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm import decontamination, language_id, near_duplicates, packing, repeated_text
from starledger.llm.common import ship, table, written


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents teach; texts without letters, and texts that no
    language explains, go. If none is taught, every text with a letter stays."""
    ship(spark)
    return language_id.in_a_language(docs, language_id.train(docs))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    ship(spark)
    return near_duplicates.keep_one(docs)


def _repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur elsewhere too; ``n_chars`` follows the text."""
    ship(spark)
    cut = repeated_text.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return cut.withColumn("n_chars", length)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    ship(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of powers of two of tokens, each from one document."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", _language),
    ("near_duplicates", _near_duplicates),
    ("repeated_text", _repeated_text),
    ("decontamination", _decontamination),
    ("packing", _packing),
]

# Trained models, hash functions and tokenizers have no form in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of all stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
