"""The registered queries of the operators, and their reference SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayer.llm import (
    byte_bpe, chat, conversation_trie, embeddings, language_id, license_scan, minhash, mixing, periodic_runs, pii,
    quality_classifier, quality_rules, url_filter,
)
from assayer.llm.common import table
from assayer.llm.oracle import ORACLE  # noqa: F401


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", ok), (-7, 1, "assistant", ok)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
    return chat.digests(given.unionByName(extra))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_byte_bpe, op3_url_filter, op4_embeddings, op5_mixing, op6_chat, op7_pii, op8_quality_rules,
    op9_language_id, op10_quality_classifier, op11_periodic_runs, op12_conversation_trie, op13_license_scan,
)}
