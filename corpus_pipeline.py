"""Corpus pipeline: reject toxic documents, drop exact copies, keep one of each near-duplicate group, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``. Rows are decided by themselves: the first stage decides
a row by its text, the second and third by its doc_id together with its text, so
rows that share a doc_id, or have none, stand or fall each on its own, and of rows
that repeat both one is left. A stage drops nothing but what its operator rejects.

Stages hold no SQL form together (the classifier and the packing have none), so
there's no ORACLE_SQL; tests compare each stage with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benefitlens.llm import exact_dedup, ngram_join, packing, toxicity
from benefitlens.llm.common import fresh_folder, table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each exact text in a digest index of its own."""
    return exact_dedup.without_copies(docs, exact_dedup.DigestIndex(spark, fresh_folder(spark, "digest-index")), "documents")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: the one with the smallest doc_id."""
    return ngram_join.without_near_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
