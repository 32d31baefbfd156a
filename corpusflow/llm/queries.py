"""Registered queries of the training-data operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat,
    decontaminate,
    filter_audit,
    language_id,
    licenses,
    mixing,
    quality,
    secret_scan,
    sharding,
    simhash,
    spelling,
    token_counts,
    toxicity,
)
from .common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_totals(table(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_sharding, op3_decontamination, op4_license_scan, op5_token_counts,
                                   op6_simhash_dedup, op7_mixing, op8_toxicity, op9_chat_formatting, op10_quality_rules, op11_filter_audit,
                                   op12_secret_scan, op13_spelling_variants)}
# Learned models, hashes and draws of the other operators cannot be stated in SQL.
ORACLE = {"op9_chat_formatting": chat.SQL, "op11_filter_audit": filter_audit.SQL, "op12_secret_scan": secret_scan.SQL}
