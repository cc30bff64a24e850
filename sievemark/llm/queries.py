"""One query for each operator of this folder, over whole tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievemark.llm import conversations, decontaminate, language, line_dedup, line_quality, maxscore, ngram_join, packing, pseudo_likelihood, suffix_dedup, surrogates, toxicity, yinyang
from sievemark.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_table(spark, sf_dir, "documents"), buckets=8, budget=65_536)


def op2_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10, shingle=5)


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.7, folds=3, held_out=1)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"), length=200)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.report(_table(spark, sf_dir, "documents"), rounds=2)


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_frequency(_table(spark, sf_dir, "documents"), host="source", limit_docs=20, limit_percent=1, deplete_percent=50)


def op8_line_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_quality.without_frequent_lines(docs, host="source", limit_docs=20, limit_percent=1, deplete_percent=50)


def op9_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.report(_table(spark, sf_dir, "documents"))


def op11_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.report(_table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op12_yinyang_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yinyang.report(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, scale=1024, salt=3)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_length_buckets": op1_length_buckets,
    "op2_prefix_decontamination": op2_prefix_decontamination,
    "op3_toxic_segments": op3_toxic_segments,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_line_dedup": op6_line_dedup,
    "op7_pseudo_likelihood": op7_pseudo_likelihood,
    "op8_line_frequency": op8_line_frequency,
    "op8_line_removal": op8_line_removal,
    "op9_language_fusion": op9_language_fusion,
    "op10_surrogates": op10_surrogates,
    "op11_maxscore_topk": op11_maxscore_topk,
    "op12_yinyang_clusters": op12_yinyang_clusters,
    "op13_conversation_repair": op13_conversation_repair,
}
