"""Semantic answer cache: lookup, and replay of a request sequence.

Replay is sequential by definition: a request is a hit when an *earlier miss* is close enough,
and only misses enter the cache. That makes the misses the greedy independent set of the
closeness relation in request order, which can be found in a few parallel rounds (Blelloch,
Fineman & Shun 2012): a request with no close earlier undecided request is decided now. Every
round is a block join, so a tenant with a third of all requests is spread over many tasks and no
pair of requests becomes a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blockjoin import similar
from ..plans.sizing import materialise

THRESHOLD = 0.92
# Fixed value: what marks an answer as cached.
HIT_PREFIX = "[RESOLVED VIA SEMANTIC CACHE] "


def lookup(requests: DataFrame, cache: DataFrame, threshold: float = THRESHOLD,
           by: list[str] | None = None, **options) -> DataFrame:
    """Nearest cached entry per request when its cosine reaches the threshold, else null.

    A cache that passes the size check is sent to the requests, so they are not shuffled.
    """
    found = similar(requests, cache, 1, metric="cosine", min_score=threshold, by=by,
                    small_corpus=True, **options)
    found = found.select("query_id", F.col("id").alias("cache_id"), "score")
    rest = requests.drop(options.get("query_vec", "embedding"))
    return rest.join(found, "query_id", "left")


def _close(left: DataFrame, right: DataFrame, tenant: str, threshold: float) -> DataFrame:
    """Nearest earlier row of ``right`` per row of ``left``, where one is close enough."""
    return similar(left, right, 1, query_id="id", by=[tenant], metric="cosine",
                   min_score=threshold, earlier_only=True)


def replay(requests: DataFrame, threshold: float = THRESHOLD, tenant: str = "tenant",
           stored: DataFrame | None = None) -> DataFrame:
    """``(tenant, id, is_hit, cache_id, score)`` of every request, as if served one by one.

    ``requests`` is ``(tenant, id, embedding)`` with ids in request order. ``stored`` holds the
    entries already cached, with ids below those of the requests.
    """
    columns = [tenant, "id", "embedding"]
    requests = materialise(requests.select(*columns))
    # Of equal vectors only the first can miss. Copies are folded before any comparison.
    firsts = requests.groupBy(tenant, "embedding").agg(F.min("id").alias("id")).select(*columns)
    if stored is not None:
        stored = stored.select(*columns)
        answered = _close(firsts, stored, tenant, threshold).select(F.col("query_id").alias("id"))
        firsts = firsts.join(answered, "id", "left_anti")
    open_rows = materialise(firsts)
    misses = [] if stored is None else [stored]
    while not open_rows.isEmpty():
        blocked = materialise(_close(open_rows, open_rows, tenant, threshold)
                              .select(F.col("query_id").alias("id")))
        new = materialise(open_rows.join(blocked, "id", "left_anti").select(*columns))
        misses.append(new)
        rest = open_rows.join(blocked, "id", "left_semi").select(*columns)
        hits = _close(rest, new, tenant, threshold).select(F.col("query_id").alias("id"))
        open_rows = materialise(rest.join(hits, "id", "left_anti").select(*columns))
    cached = misses[0] if misses else requests.limit(0)
    for part in misses[1:]:
        cached = cached.unionByName(part)
    found = _close(requests, cached, tenant, threshold).select(
        F.col("query_id").alias("id"), F.col("id").alias("cache_id"), "score")
    return requests.select(tenant, "id").join(found, "id", "left").select(
        tenant, "id", F.col("cache_id").isNotNull().alias("is_hit"), "cache_id", "score")


def answer(hits: DataFrame, cached_response: str = "cached_response") -> DataFrame:
    """Mark answers that come from the cache; an empty one counts as a miss."""
    good = F.coalesce(F.col(cached_response) != "", F.lit(False))
    return hits.withColumn("response", F.when(good, F.concat(F.lit(HIT_PREFIX), cached_response)))
