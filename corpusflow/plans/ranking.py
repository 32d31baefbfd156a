"""Top-k per group and whole-table numbering that never sort one group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sizing import broadcast_if_small, materialise


def top_k(df: DataFrame, k: int, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group with a 1-based rank.

    ``row_number() <= k`` is planned as a limit inside each task before the shuffle, so at most
    ``k`` rows of a group leave each task, however many rows the group has.
    """
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def with_rank(df: DataFrame, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """1-based rank inside groups that an earlier top-k has already cut to a few rows."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def explode_list(df: DataFrame, keep: list, items, value: str, position: str | None = None) -> DataFrame:
    """One row per list element, next to the ``keep`` columns.

    A plain explode makes Catalyst add a filter for empty lists and push it down, which computes
    a derived list (a splitter, a tokeniser) twice and ahead of a rebalance. The outer form with
    a filter on the element gives the same rows and computes the list once.
    """
    out = df.select(*keep, F.posexplode_outer(items).alias("_pos", value))
    out = out.where(F.col("_pos").isNotNull())
    return out.withColumnRenamed("_pos", position) if position else out.drop("_pos")


def number_rows(df: DataFrame, order: list[Column], by: list[str] | None = None,
                name: str = "rank") -> DataFrame:
    """1-based ``row_number`` over whole groups of any size, with one shuffle of the rows.

    Rows are range-partitioned on (group, order), so a hot group spreads over many tasks, sorted
    there and checkpointed, which fixes the place of each row. ``monotonically_increasing_id``
    then gives that place (partition above, position below), and the runs of a group, at most
    partitions + groups rows, turn places into ranks. ``order`` must be total, which also lets
    the range bounds cut inside ties of its leading columns. Null groups are groups like others.
    """
    by = by or []
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [*[F.col(c) for c in by], *order]
    placed = (materialise(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
              .withColumn("_at", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright("_at", 33)))
    runs = placed.groupBy("_part", *by).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    runs = materialise(runs.select(F.col("_part").alias("_run"), *[F.col(c).alias(f"_by_{c}") for c in by],
                                   shift.alias("_shift")))
    same = F.col("_part") == F.col("_run")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (placed.join(broadcast_if_small(runs), same)
            .withColumn(name, F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_run", "_shift", *[f"_by_{c}" for c in by]))
