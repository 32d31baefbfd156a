"""Structured Streaming forms of the incremental behaviours.

All jobs read with a file source, keep state in checkpoints or parquet tables on shared storage,
and run until the available input is used up, so a restart carries on where the last run stopped.
Batches are written under their batch number and replaced on a retry, which makes the sinks
idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cache as C
from ..operators import sparse
from ..operators.usage import health_report, health_totals
from ..plans.sizing import is_folder, path_exists
from ..sources.stores import CACHE_SCHEMA, cache_misses, embed_table


def file_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of one table, its own file or a folder of part files. Tables beside it are not listed."""
    path = f"{folder}/{name}"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if not is_folder(spark, path):
        # A file source takes a folder or a pattern, no single file; this pattern fits the one name.
        path = f"{folder}/[{name[0]}]{name[1:]}"
    return stream.parquet(path)


def _run(stream: DataFrame, each_batch, checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _put(df: DataFrame, root: str, table: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch={batch}")


def _all(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")


def ingest(stream: DataFrame, root: str, namespace: str = "default") -> None:
    """Keep vectors and sparse statistics in step with arriving documents.

    Each batch adds its documents, the vectors of texts not seen before, and additive term and
    length counts. Nothing is rebuilt.
    """
    def each_batch(docs: DataFrame, batch: int) -> None:
        spark = docs.sparkSession
        _put(docs, root, "documents", batch)
        docs = spark.read.parquet(f"{root}/documents/batch={batch}")
        index = sparse.index_documents(docs)
        _put(sparse.term_stats(index), root, "term_stats", batch)
        _put(sparse.corpus_stats(index), root, "corpus_stats", batch)
        known = spark.createDataFrame([], CACHE_SCHEMA)
        if path_exists(spark, f"{root}/vectors"):
            known = _all(spark, root, "vectors").where(F.col("batch") < batch).select(
                "namespace", "content_hash", "embedding")
        vectors = embed_table(cache_misses(docs, known, namespace), "content_hash", "text").select(
            F.lit(namespace).alias("namespace"), F.col("id").alias("content_hash"), "embedding")
        _put(vectors, root, "vectors", batch)

    _run(stream, each_batch, f"{root}/checkpoint")


def ingested_search(spark: SparkSession, root: str, queries: DataFrame, k: int) -> DataFrame:
    """BM25 over everything ingested so far, from the merged additive statistics."""
    docs = _all(spark, root, "documents")
    return sparse.bm25(queries, docs, k,
                       stats=sparse.merge_stats(_all(spark, root, "term_stats").select("term", "df")),
                       totals=sparse.merge_corpus_stats(
                           _all(spark, root, "corpus_stats").select("n_docs", "sum_terms")))


def running_health(rows: DataFrame, root: str) -> DataFrame:
    """Health totals kept in streaming state; the latest state is reported.

    The state is one row of sums, updated after each batch.
    """
    def each_batch(totals: DataFrame, batch: int) -> None:
        _put(totals, root, "health", batch)

    query = (rows.agg(*health_totals(rows)).writeStream.outputMode("complete").foreachBatch(each_batch)
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    states = _all(rows.sparkSession, root, "health")
    latest = states.agg(F.max("batch")).scalar()
    return health_report(states.where(F.col("batch") == latest))


def replay_cache(requests: DataFrame, root: str, threshold: float, tenant: str = "tenant") -> DataFrame:
    """Serve arriving requests from a cache that grows by their misses.

    Requests must arrive in id order from one batch to the next. Each batch is first compared
    with the stored entries and then replayed among itself, both as block joins, so a busy
    tenant is not bound to one task.
    """
    def each_batch(batch_rows: DataFrame, batch: int) -> None:
        spark = batch_rows.sparkSession
        stored = None
        if path_exists(spark, f"{root}/entries"):
            stored = _all(spark, root, "entries").where(F.col("batch") < batch)
        _put(batch_rows, root, "requests", batch)
        rows = spark.read.parquet(f"{root}/requests/batch={batch}")
        _put(C.replay(rows, threshold, tenant, stored), root, "served", batch)
        served = spark.read.parquet(f"{root}/served/batch={batch}")
        _put(rows.join(served.where(~F.col("is_hit")).select("id"), "id", "left_semi"),
             root, "entries", batch)

    _run(requests, each_batch, f"{root}/checkpoint")
    return _all(requests.sparkSession, root, "served").drop("batch")
