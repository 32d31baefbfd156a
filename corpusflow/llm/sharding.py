"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations alone.

Every shard stands on the ring at ``NODES`` places and a row belongs to the first node at or
clockwise of its own place, which its key decides. Shards have a bounded capacity. In each round
all rows still homeless stand before their next node, whose shard takes them, in ring order, as
far as it has room; the others go on clockwise to the following node.

Rows of one arc of the ring always move together and in a fixed order, so the rounds need the
number of rows of each arc only: at most shards x nodes counts, whatever the number of rows.
They give runs "ranks a to b of arc x lie in shard s from slot c on", and one numbering of the
rows inside their arcs with a small join places each row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans.ranking import number_rows

from .common import fresh, let

NODES = 64      # virtual nodes of a shard
RING = 1 << 16  # places on the ring


def place_of(*key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 48)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few bounded rows, without Python in its plan."""
    names = [c.split()[0] for c in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))))


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of every node in ring order; a place that two want goes to the lower shard."""
    points = spark.range(shards * nodes).select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("node"))
    taken = points.groupBy(place_of(F.lit("node"), F.col("shard"), F.col("node")).alias("place")).agg(F.min("shard").alias("shard"))
    return [(r.place, r.shard) for r in taken.orderBy("place").collect()]


def fill(counts: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(arc, first, last, shard, slot)`` of ranks from 1, after all rounds.

    ``counts`` and ``owners`` are rows and shard of each arc in ring order.
    """
    n = len(counts)
    room, used = list(capacity), [0] * len(capacity)
    waiting = [(arc, 1) for arc in range(n) if counts[arc]]
    runs, step = [], 0
    while waiting:
        on = []
        for arc, first in waiting:
            shard = owners[(arc + step) % n]
            got = min(room[shard], counts[arc] - first + 1)
            if got:
                runs.append((arc, first, first + got - 1, shard, used[shard]))
                room[shard] -= got
                used[shard] += got
            if first + got <= counts[arc]:
                on.append((arc, first + got))
        waiting, step = on, step + 1
    return runs


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold: the mean plus ``slack``. Without slack counts end at most one apart."""
    if slack:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place(rows: DataFrame, key: list[str], shards: int, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    The key decides the place on the ring; null keys have a place like any other. Ties of a key
    are ordered by all columns, so the result does not depend on the order of the input; rows
    equal in every column share their slots among them. Columns called ``shard`` or ``slot`` are
    replaced, all others kept. An empty table gives an empty result.
    """
    rows = rows.drop("shard", "slot")
    spark = rows.sparkSession
    arcs = ring(spark, shards, nodes)
    ends = [p for p, _ in arcs]
    arc, at, rank, tie, spot = fresh(rows, "arc", "at", "rank", "tie", "spot")
    # An arc owns the places after the node before it; behind the last node the first one follows.
    spans = [(i, ends[i - 1] + 1 if i else 0, e) for i, e in enumerate(ends)] + [(0, ends[-1] + 1, RING - 1)]
    spans = small_table(spark, [s for s in spans if s[1] <= s[2]], "arc int,lo long,hi long")
    spans = spans.select(F.col("arc").alias(arc), F.explode(F.sequence("lo", "hi")).alias(at))
    plain = [F.col(f"`{c}`").cast("string") if t.startswith(("map", "variant")) else F.col(f"`{c}`") for c, t in rows.dtypes]
    placed = (rows.withColumns({at: place_of(*[F.col(c) for c in key]), tie: F.xxhash64(*plain)})
              .join(F.broadcast(spans), at))  # RING rows
    counts = {r[0]: r[1] for r in placed.groupBy(arc).count().collect()}  # at most shards x nodes rows
    counts = [counts.get(i, 0) for i in range(len(arcs))]
    runs = fill(counts, [s for _, s in arcs], capacities(sum(counts), shards, slack))
    runs = small_table(spark, runs or [(0, 1, 0, 0, 0)], "arc int,first long,last long,shard int,start long")
    runs = runs.select(F.col("arc").alias(arc), F.struct("first", "last", "shard", "start").alias(spot))
    order = [F.col(at), *[F.col(c) for c in key], F.col(tie), F.monotonically_increasing_id()]
    numbered = number_rows(placed, order, [arc], rank)
    # One small array per arc instead of a row per run keeps this an equality join.
    runs = runs.groupBy(arc).agg(F.collect_list(spot).alias(spot))
    mine = F.filter(spot, lambda r: (F.col(rank) >= r["first"]) & (F.col(rank) <= r["last"]))[0]
    out = numbered.join(F.broadcast(runs), arc).withColumn(spot, let(mine, lambda r: r))
    return out.withColumns({"shard": F.col(f"{spot}.shard"), "slot": F.col(f"{spot}.start") + F.col(rank) - F.col(f"{spot}.first")}
                           ).drop(arc, at, rank, tie, spot)


def sharded(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Shard and slot of every document under the law ``rows``: counts are at most one apart.

    ``size`` is the UTF-8 length of the text plus 16 (null counts as none), ``text_crc32`` the
    checksum of the text (null like empty). Texts are not moved, only these numbers are.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, (F.octet_length(body) + 16).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    return place(rows, ["doc_id"], shards).withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", *keep, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
