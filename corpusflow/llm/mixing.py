"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations alone.

A source's target over its size is the expected number of copies of each of its documents. The
whole part is taken; the fractions are rounded together. Two documents with fractions a and b
fight: if a + b is under one, one of them gets a + b and the other nothing, else one gets a full
copy and the other keeps a + b - 1, with the odds that leave each one's expectation as it was.
So every fight settles one document, and the number of copies stays what it was.

Documents of a source are ordered by size, so that fights are between neighbours of about equal
size and the words taken stay close to the target too. Runs of ``RUN`` documents are folded in
place, and what each leaves open goes up a reduction tree, ``RUN`` to one, up to one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.plans.ranking import number_rows
from corpusflow.plans.sizing import broadcast_if_small

from .common import fresh, stored, text_or_empty, uniform

WEIGHTS = (5, 2, 1)  # of the sources by name, over and over
SHARE = 1.5          # of all sizes that the mix holds
MOST = 2.0           # times a source's or document's size at most
RUN = 64             # documents folded at a time
TINY = 1e-9


def words(text: str) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_no, source_size, target)`` from ``sizes(source, source_size)``.

    Sources share ``share`` of all sizes by weight; one that would get over ``most`` times its
    size stops there and the excess goes to the others by weight. In ascending order of
    ``size / weight`` those are a prefix, so running sums tell them apart.
    """
    no = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("source_no", no).withColumns({"weight": weight, "cap": most * F.col("source_size")})
    before = W.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    open_level = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(open_level * F.col("weight"))
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def _fold(units: Column, level: int, seed: int) -> Column:
    """Let the units of a run fight one after another: what is left open, and who got a copy."""
    state = F.struct(F.lit(-1).cast("long").alias("rank"), F.lit(0.0).alias("p"), F.array().cast("array<long>").alias("won"))

    def step(s: Column, x: Column) -> Column:
        total = s["p"] + x["p"]
        u = uniform(F.lit(seed), F.lit(level), s["rank"], x["rank"], x["salt"])
        over = total >= 1 - TINY
        first = F.when(over, u * (2 - total) < 1 - x["p"]).otherwise(u * total < s["p"])  # the held one wins
        rest = F.when(total - 1 < TINY, 0.0).otherwise(total - 1)
        held = F.when(over, F.struct(F.when(first, x["rank"]).otherwise(s["rank"]).alias("rank"), rest.alias("p"),
                                     F.concat(s["won"], F.array(F.when(first, s["rank"]).otherwise(x["rank"]))).alias("won")))
        return F.when(x["p"] < TINY, s).otherwise(held.otherwise(
            F.struct(F.when(first, s["rank"]).otherwise(x["rank"]).alias("rank"), total.alias("p"), s["won"].alias("won"))))

    return F.aggregate(units, state, step)


def rounded(units: DataFrame, longest: int, seed: int = 7, run: int = RUN) -> DataFrame:
    """``(source_no, rank)`` of the units that get one copy more, from ``units(source_no, rank, p)``.

    ``longest`` is the greatest rank. Each level of the tree keeps one unit of ``run``; the last
    open fraction of a source is settled by a draw.
    """
    won, level = [], 0
    units = units.select("source_no", "rank", "p", F.col("rank").alias("place"))
    while True:
        groups = units.groupBy("source_no", F.floor((F.col("place") - 1) / run).alias("run_no")).agg(
            F.sort_array(F.collect_list(F.struct("place", "rank", "p", F.col("source_no").alias("salt")))).alias("units"))
        folded = stored(groups.select("source_no", "run_no", _fold(F.col("units"), level, seed).alias("s")), f"pivotal-{level}")
        won.append(folded.select("source_no", F.explode("s.won").alias("rank")))
        units = folded.where(F.col("s.p") > 0).select("source_no", F.col("s.rank").alias("rank"), F.col("s.p").alias("p"),
                                                      (F.col("run_no") + 1).alias("place"))
        level, longest = level + 1, -(-longest // run)
        if longest <= 1:
            break
    last = uniform(F.lit(seed), F.lit(-1), F.col("source_no"), F.col("rank")) < F.col("p")
    won.append(units.where(last).select("source_no", "rank"))
    return reduce(DataFrame.unionAll, won)


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """How often the mix takes each document: one row for each row of ``docs``.

    ``(doc_id, row_hash, size, source_size, target, copies, taken)``; ``size`` is the number of
    words and ``taken`` is ``copies * size``, at most twice the size. ``row_hash`` covers the
    columns read. Draws depend on the order of sizes, ids and hashes alone: reruns agree, whatever
    the partitioning.

    Null and blank texts have size 0; the null source is a source, the last one. Sources
    without words have target 0 and no copies. Repeated rows each get their own draw. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), words(text).alias("size"),
                              F.xxhash64(F.col(text), F.col(doc_id), F.col(source)).alias("row_hash")), "mix-sizes")
    plan = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    known = plan.select(F.col("source").alias("_source"), "source_no", "source_size", "target",
                        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    rows = rows.join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.least(F.col("rate"), F.lit(MOST))
    sure = F.floor(rate + TINY)
    rows = rows.withColumns({"sure": sure, "p": F.when(rate - sure < TINY, 0.0).otherwise(rate - sure)}).drop("rate")
    numbered = stored(number_rows(rows, [F.desc("size"), F.col("doc_id"), F.col("row_hash"), F.monotonically_increasing_id()],
                                  ["source_no"]), "mix-order")
    longest = numbered.agg(F.max("rank")).first()[0] or 0
    more = rounded(numbered.where("p > 0"), longest, seed).withColumn("more", F.lit(1))
    out = numbered.join(more, ["source_no", "rank"], "left")
    taken = (F.col("sure") + F.coalesce("more", F.lit(0))).cast("long")
    return out.withColumn("copies", taken).select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame) -> DataFrame:
    """Words that the mix takes of each document."""
    return copies(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns kept, whatever their names.

    Texts move only if the counts are too many to be sent to where the texts are. Rows with equal
    id, text and source share their copies in turn; null ids, texts and sources are values like
    others, and an empty table gives an empty result.
    """
    ident, key, n, of, nth, own = fresh(docs, "_id", "_row_hash", "_copies", "_of", "_nth", "_hash")
    plan = copies(docs, doc_id, text, source).groupBy(F.col("doc_id").alias(ident), F.col("row_hash").alias(key)).agg(
        F.sum("copies").alias(n), F.count(F.lit(1)).alias(of))
    plan = stored(plan, "mix-plan")
    rows = docs.withColumn(own, F.xxhash64(F.col(text), F.col(doc_id), F.col(source)))
    rows = rows.join(plan, F.col(doc_id).eqNullSafe(F.col(ident)) & (F.col(own) == F.col(key)))
    # Rows that are there once, nearly all, take all copies; rows of one key share them in turn.
    shared = W.partitionBy(ident, key).orderBy(F.lit(1))
    many = rows.where(F.col(of) > 1).withColumn(nth, F.row_number().over(shared))
    many = many.withColumn(n, F.floor((F.col(n) + F.col(of) - F.col(nth)) / F.col(of))).drop(nth)
    rows = rows.where(F.col(of) == 1).unionByName(many)
    return rows.withColumn(nth, F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
