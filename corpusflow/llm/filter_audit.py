"""How five filters interact, over all 120 orders in which they can be applied.

A document is told by the set (mask) of filters that it fails. Whatever the order, it is removed
by the first filter of its mask, so all orders that begin alike up to that filter remove it at the
same step. In lexicographic (Lehmer) rank those orders are one interval. Each mask therefore adds
its counts where its intervals begin and takes them off where they end, and a prefix sum over the
120 ranks gives what every step of every order removes. The work on documents is one pass that
ends in at most 32 counts per part; nothing is done per document and order.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.plans.sizing import broadcast_if_small

from .common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # by Lehmer rank
COUNTS = ("n", "good", "toxic")
BLANKS = " \t\n\x0b\x0c\r"


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """``(step, first, past)``: in orders of rank ``first`` to ``past - 1`` the mask goes at ``step``."""
    out: list[tuple[int, int, int]] = []

    def walk(left: str, step: int, first: int) -> None:
        width = factorial(len(left) - 1)
        for digit, letter in enumerate(left):  # the Lehmer digit of this step
            at = first + digit * width
            if not mask >> FILTERS.index(letter) & 1:
                if len(left) > 1:
                    walk(left.replace(letter, ""), step + 1, at)
            elif out and out[-1][0] == step and out[-1][2] == at:
                out[-1] = (step, out[-1][1], at + width)
            else:
                out.append((step, at, at + width))

    walk(FILTERS, 1, 0)
    return out


def text_failures(text: str) -> Column:
    """Mask of the filters that a text fails by itself: A, B, C and D."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    inner = F.btrim(body, F.lit(BLANKS))
    words = F.when(inner != "", F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    n_words, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(F.regexp_replace(body, "[^A-Z]+", ""))
    fails = [n_words < 200, 100 * kinds.cast("long") < 50 * n_words.cast("long"),
             100 * capitals.cast("long") > 2 * F.char_length(body).cast("long"), body.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: how many documents of a part fail just the filters of a mask.

    Texts are read once and leave behind a digest; the later copy of a text is told by joining
    rows with the least id of their digest on (digest, id), a key that copies do not share.
    """
    ident = F.col(doc_id).cast("long")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = stored(docs.select(ident.alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"),
                              text_failures(text).alias("own"), F.unhex(F.sha2(body, 256)).alias("digest")), "audit-rows")
    first = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"))
    later = rows.join(first.select(F.col("digest").alias("_d"), "least"),
                      (F.col("digest") == F.col("_d")) & (F.col("id") == F.col("least")), "left")
    copy = F.col("id").isNotNull() & F.col("least").isNull()
    marks = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("good = 1 OR toxic = 1")
    flagged = later.select("id", "part", (F.col("own") + F.when(copy, 16).otherwise(0)).alias("mask")).join(
        broadcast_if_small(marks), F.col("id") == F.col("_id"), "left")
    return flagged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"))


def _fixed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table whose size follows from the number of filters alone."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of ``counts(part, mask, n, good, toxic)``: 600 rows for each part, zeros included."""
    spark = counts.sparkSession
    counts = stored(counts, "audit-masks")
    spans = _fixed(spark, [(m, *s) for m in range(1, 1 << len(FILTERS)) for s in intervals(m)],
                   "mask int, step int, first int, past int")
    covered = counts.join(spans, "mask")
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("past").alias("rank"), F.lit(-1).alias("sign"))))
    deltas = covered.select("part", "step", ends.alias("end"), *COUNTS).select(
        "part", "step", "end.rank", *[(F.col("end.sign") * F.col(c)).alias(c) for c in COUNTS])
    bit = [F.col("mask").bitwiseAND(1 << k) != 0 for k in range(len(FILTERS))]
    parts = stored(counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(b, F.col("n")).otherwise(0)) for b in bit]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(len(FILTERS))]).alias("alone")),
        "audit-parts")
    every = F.sequence(F.lit(0), F.lit(len(ORDERS) * len(FILTERS) - 1))
    grid = parts.select("part", F.explode(every).alias("k")).select(
        "part", (F.col("k") % len(FILTERS) + 1).alias("step"), F.expr(f"k div {len(FILTERS)}").cast("int").alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    changes = deltas.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    upto = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    steps = changes.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in COUNTS])
    steps = steps.join(_fixed(spark, list(enumerate(ORDERS)), "rank int, filter_order string"), "rank")  # drops rank 120
    letter = F.instr(F.lit(FILTERS), F.expr("substring(filter_order, step, 1)"))
    steps = steps.withColumn("letter", letter).join(parts, "part")
    so_far = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("letter")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("letter")).alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(W.partitionBy("part", "letter")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what that step keeps and removes.

    The parts are the sources; a null source and an empty one are the part ``''``. A null text is
    empty, so it fails A and equals every other empty or null text. A row without an id is no
    earlier copy of anything, never fails E and has no labels; rows with the same id and text are
    no copies of each other, as neither has the smaller id. A document with several labels is
    good or toxic if one of them says so. Other columns are not read; an empty table has no parts
    and gives no rows.
    """
    return interactions(masks(docs, labels))


SQL = r"""
WITH base AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
facts AS (
    SELECT doc_id, part,
           [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
            100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body),
            regexp_matches(body, '[#$%&*|]'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS fails
    FROM base),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM facts LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS p
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT filter_order, p, i AS step, p[i] AS f FROM orders, letters),
told AS (
    SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS fails_it,
           len(list_filter(p[1:step - 1], lambda q: fails[q])) > 0 AS gone_before,
           len(list_filter(fails, lambda y: y)) AS n_fails
    FROM masks, steps),
counted AS (
    SELECT part, filter_order, step, f,
           sum(n) FILTER (WHERE NOT gone_before AND NOT fails_it) AS kept,
           sum(n) FILTER (WHERE NOT gone_before AND fails_it) AS removed,
           sum(n) FILTER (WHERE gone_before AND fails_it) AS redundant,
           sum(n) FILTER (WHERE fails_it AND n_fails = 1) AS unique_fails,
           sum(good) FILTER (WHERE NOT gone_before AND fails_it) AS good_lost,
           sum(toxic) FILTER (WHERE NOT gone_before AND fails_it) AS toxic_lost
    FROM told GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted
"""
