"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from benefitlens.llm import align, bpe, exact_dedup, html_layout, imatch, ngram_join, packing, pq_dedup, prefix_trie, quotes, token_counts, token_files, toxicity
from benefitlens.llm.common import fresh_folder, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digest-index"))
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), index, "documents").drop("row")


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "token-ids")
    token_files.write_token_ids(table(spark, sf_dir, "documents"), path)
    return token_files.ids_digest(token_files.read_token_ids(spark, path))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_likeness(table(spark, sf_dir, "documents"))


def op8_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_budget(token_counts.prefix_token_counts(table(spark, sf_dir, "documents")), 1024)


def op10_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(table(spark, sf_dir, "conversations"))


def op11_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_byte_bpe, op2_exact_dedup, op3_toxicity_chain, op4_best_fit_packing, op5_token_files,
    op6_ngram_jaccard, op7_imatch, op8_html_layout, op9_token_counts, op10_quotation_links,
    op11_pq_near_dedup, op12_prefix_trie, op13_token_alignment,
)}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": exact_dedup.ORACLE, "op10_quotation_links": quotes.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
