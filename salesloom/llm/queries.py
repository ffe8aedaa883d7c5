"""The operators applied to their whole tables: one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import (
    bpe, convtrie, decontam, fingerprint, neardup, quality, runs, suffix, tokenfiles, topk, toxicity, urls, webtext,
)
from salesloom.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_digests(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.document_counts(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Rule(words=3, percent=85))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_quality, op3_repeated_strings, op4_html_text, op5_decontamination, op6_bpe,
                                  op7_toxicity, op8_token_counts, op9_near_duplicates, op10_fingerprints, op11_exact_topk,
                                  op12_periodic_runs, op13_conversation_trie)}
ORACLE: dict[str, str] = {"op11_exact_topk": topk.ALL_PAIRS, "op13_conversation_trie": convtrie.ALL_PREFIXES}
