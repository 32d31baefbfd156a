"""Parquet-backed stores: vectors, embedding cache, sparse statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embed import DIM, embed
from ..functions.text import text_key
from ..plans.sizing import broadcast_if_small, materialise, path_exists, spread

CACHE_SCHEMA = "namespace string, content_hash string, embedding array<float>"


def embed_table(docs: DataFrame, id: str = "doc_id", text: str = "text", dim: int = DIM,
                embedder=embed) -> DataFrame:
    """``(id, embedding)`` for every document. ``embedder`` is any text-to-vector function."""
    return spread(docs.select(id, text), id).select(
        F.col(id).alias("id"), embedder(F.col(text), dim).alias("embedding"))


def save(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write a store. ``overwrite`` replaces an older one, ``append`` adds to it.

    With ``partition_by`` the rows are rebalanced on those columns first: AQE merges small pieces
    and splits a hot value, so neither many tiny files nor one huge task comes out.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return path
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def cache_or_empty(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    return spark.createDataFrame([], CACHE_SCHEMA)


def cache_misses(docs: DataFrame, cache: DataFrame, namespace: str, text: str = "text",
                 id: str = "doc_id") -> DataFrame:
    """Distinct texts without a cached vector: ``(content_hash, text)``.

    Only hashes and ids are compared, and copies are combined in each task before the shuffle, so
    a text that makes up a third of the corpus leaves each task once. Texts are then fetched for
    the misses alone.
    """
    firsts = docs.groupBy(text_key(text).alias("content_hash")).agg(F.min(id).alias(id))
    known = cache.where(F.col("namespace") == namespace).select("content_hash")
    missing = materialise(firsts.join(known, "content_hash", "left_anti"))
    return docs.select(id, F.col(text).alias("text")).join(
        broadcast_if_small(missing, "128"), id).select("content_hash", "text")


def fill_cache(spark: SparkSession, docs: DataFrame, path: str, namespace: str, dim: int = DIM,
               embedder=embed, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Compute and append what is missing, then read every vector from the cache."""
    cache = cache_or_empty(spark, path)
    missed = cache_misses(docs, cache, namespace, text, id)
    fresh = spread(missed, "content_hash").select(
        F.lit(namespace).alias("namespace"), "content_hash", embedder(F.col("text"), dim).alias("embedding"))
    save(fresh, path, "append")
    vectors = load(spark, path).where(F.col("namespace") == namespace).select("content_hash", "embedding")
    return docs.withColumn("content_hash", text_key(text)).join(vectors, "content_hash")
