"""Corpus preparation: language ID, exact dedup, near-duplicate join, packing.

Every stage reads all that the one before it kept, as a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import exact_dedup, language_id, ngram_join, packing
from lotwise.sources.staging import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told apart; what the classifier rejects goes."""
    judged = docs.withColumn("_found", language_id.predicted(F.col("text"), language_id.model_of(docs)))
    kept = F.col("_found.lang") != language_id.UNKNOWN
    return judged.filter(kept & (F.col("_found.margin") >= language_id.NARROW)).select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier."""
    return exact_dedup.keep_distinct(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, on shingles of five words and a similarity of 0.8 or
    more, the document with the smallest identifier."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", distinct_contents),
    ("best-fit packing", sequences),
]
# Neither compression sizes nor tokens can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are kept, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, keep in STAGES:
        docs = stage(keep(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
