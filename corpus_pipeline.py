"""A corpus from raw documents to shards, in five stages over Parquet.

Each stage works on all rows that its predecessor kept and only adds decisions of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, language_id, mixing, sharding, simhash
from corpusflow.llm.common import fresh, stored, table
from corpusflow.plans.sizing import broadcast_if_small


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the model rejects: no letters, or more likely wrong than right.

    Null and blank texts have no letters. Columns named like the operator's own come out as they were.
    """
    clash = [c for c in docs.columns if c.lower() in ("lang_pred", "score", "rejected")]
    held = dict(zip(clash, fresh(docs, *[f"_{c}" for c in clash]), strict=True))
    told = language_id.identify(docs.withColumnsRenamed(held), language_id.train(docs))
    told = told.where(~F.col("rejected")).drop("lang_pred", "score", "rejected")
    return told.withColumnsRenamed({v: k for k, v in held.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group; rows without an id are no copies to name and stay.

    Only ids of documents to drop meet the texts. An id that stands on several rows keeps one.
    """
    ident, drop, twice = fresh(docs, "_id", "_drop", "_twice")
    said = simhash.near_duplicates(docs).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(ident)).agg(
        F.max(F.col("doc_id") != F.col("component_id")).alias(drop), (F.count(F.lit(1)) > 1).alias(twice))
    said = stored(said.where(F.col(drop) | F.col(twice)), "decisions")
    left = docs.join(broadcast_if_small(said), F.col("doc_id") == F.col(ident), "left").where(~F.coalesce(drop, F.lit(False)))
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = left.where(~F.coalesce(twice, F.lit(False))).select(*own)
    if said.where(F.col(twice) & ~F.col(drop)).isEmpty():
        return once
    return once.unionByName(left.where(F.col(twice)).select(*own).dropDuplicates(["doc_id"]))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, also with other numbers, names or units.

    Rows are told apart by a hash of id and text, so a row without an id is judged by its own
    text, and so are texts that share an id. Null and blank texts hold nothing.
    """
    key, = fresh(docs, "_row")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), doc_id=key)
    named = stored(found.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return rows.join(broadcast_if_small(named), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; null ids, texts and sources are values like others."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every copy, also of rows without an id or a text."""
    return sharding.sharded(docs, keep=("source",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources), ("sharding", shard)]

# A learned model and hashed draws cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
