"""Queries of the training-data operators, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from svgspark.llm import (
    alignment, embed_dedup, line_dedup, mixing, near_dup, packing, periodic, quality_rank, quality_rules,
    secrets, sharding, suffix_dedup, toxicity,
)
from svgspark.llm.common import small_batches, table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op3(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op5(table(spark, sf_dir, "documents"))


def op6_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op8(table(spark, sf_dir, "documents"))


def op9_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rank.score(docs, quality_rank.train(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op11(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(small_batches(spark), sf_dir, "documents"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op13(table(small_batches(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_near_dup": op2_near_dup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_embed_dedup": op6_embed_dedup,
    "op7_best_two_fit": op7_best_two_fit,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rank": op9_quality_rank,
    "op10_quality_rules": op10_quality_rules,
    "op11_sharding": op11_sharding,
    "op12_alignment": op12_alignment,
    "op13_periodic": op13_periodic,
}

ORACLE: dict[str, str] = {
    "op2_near_dup": near_dup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op6_embed_dedup": embed_dedup.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
}
