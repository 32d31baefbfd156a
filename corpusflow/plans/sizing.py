"""Size checks made before anything is broadcast, and scratch space on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds for data sent to every executor. Anything larger takes a shuffled plan.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, width: str | None = None, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is proven small enough to broadcast.

    ``width`` is a SQL expression for the bytes of one row. The check reads at most
    ``max_rows + 1`` rows, so it stays cheap on a huge input.
    """
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.expr(width or "64").cast("bigint")), F.lit(0)).alias("bytes"))
    n, size = probe.first()
    return n <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, width: str | None = None,
                       max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only behind a size check; otherwise leave the join to AQE."""
    return F.broadcast(df) if fits_broadcast(df, width, max_rows) else df


def few_rows(queries: DataFrame, per_query: int) -> bool:
    """True when a ranked list of ``per_query`` rows per query is small by construction."""
    return fits_broadcast(queries, None, MAX_BROADCAST_ROWS // max(per_query, 1))


def rows_of(ranked: DataFrame, docs: DataFrame, columns: list, small: bool) -> DataFrame:
    """Join ranked ids to their document columns.

    ``small`` comes from ``few_rows``: then the ranked side goes to the scan and the documents
    are not shuffled; otherwise AQE decides.
    """
    wanted = F.broadcast(ranked) if small else ranked
    return docs.select(*columns).join(wanted, "id")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = getattr(spark, "_corpusflow_dir", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="corpusflow-")
        spark._corpusflow_dir = folder
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/corpusflow/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint; the rows then survive executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write once to the shared folder and read back: columnar, pruned, and computed a single time."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rebalance a narrow, compute-heavy job only when the input has too few files.

    A corpus of many files is read in place, with no shuffle. A handful of files holds fewer
    row groups than there are cores, so there the rows are hashed over the cores first.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # Counted in the JVM: the list of a large corpus is long.
    if len(df._jdf.inputFiles()) >= cores:
        return df
    return df.repartition(cores, *[F.col(k) for k in keys])


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system, so it works on any store."""
    hadoop_path, system = _hadoop(spark, path)
    return system.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """A table may be one file or a folder of part files."""
    hadoop_path, system = _hadoop(spark, path)
    return system.exists(hadoop_path) and system.getFileStatus(hadoop_path).isDirectory()


def in_groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit`` at most, or hold one item."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
