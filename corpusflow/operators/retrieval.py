"""Dense retrieval: exact top-k, full rankings, diversity, derived lists.

Every retriever returns ``(query_id, id, rank, score)``: best first, 1-based rank, ties by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.embed import DIM, signature
from ..plans.blockjoin import id_column, similar
from ..plans.ranking import number_rows, with_rank
from ..plans.sizing import broadcast_if_small, few_rows, materialise, rows_of, spread
from .chunking import parent_child


def nearest(queries: DataFrame, corpus: DataFrame, k: int, **options) -> DataFrame:
    """Exact top-k by dot product (cosine order for unit vectors)."""
    return similar(queries, corpus, k, **options)


def nearest_with_scores(queries: DataFrame, corpus: DataFrame, k: int = 3, **options) -> DataFrame:
    """Top-k by squared L2 distance, with the distance and ``1 / (1 + distance)``."""
    found = similar(queries, corpus, k, metric="l2", **options)
    distance = F.abs("score")
    return found.select("query_id", "id", "rank", distance.alias("distance"),
                        F.round(V.distance_similarity(distance), 6).alias("similarity"))


def nearest_filtered(queries: DataFrame, corpus: DataFrame, k: int, condition, **options) -> DataFrame:
    """Filter the corpus on its metadata, then search; the filter reaches the scan."""
    return similar(queries, corpus.where(condition), k, **options)


def similarity_matrix(queries: DataFrame, corpus: DataFrame, **options) -> DataFrame:
    """Cosine of every query to every corpus row."""
    return (similar(queries, corpus, None, metric="cosine", **options)
            .withColumnRenamed("score", "similarity"))


def full_ranking(queries: DataFrame, corpus: DataFrame, **options) -> DataFrame:
    """All corpus rows per query in cosine order, numbered without a one-task sort."""
    scored = similar(queries, corpus, None, metric="cosine", **options)
    return number_rows(scored, [F.desc("score"), F.asc("id")], by=["query_id"])


def mmr(candidates: DataFrame, k: int = 3, trade_off: float = 0.5) -> DataFrame:
    """Greedy maximal marginal relevance (Carbonell & Goldstein 1998).

    ``candidates`` is ``(query_id, id, rank, score, embedding)`` with a few rows per query, as cut
    by a top-k. Each step takes the row with the largest
    ``trade_off * score - (1 - trade_off) * max similarity to the rows taken``; ties keep rank order.
    """
    pool = candidates.groupBy("query_id").agg(F.array_sort(F.collect_list(
        F.struct("rank", "id", "score", V.as_double("embedding").alias("vec")))).alias("pool"))

    def value(c, i, state):
        gain = F.lit(trade_off) * c["score"] - F.lit(1.0 - trade_off) * F.get(state["near"], i)
        free = ~F.array_contains(state["taken"], i)
        return F.when(free, F.round(gain, 6))

    def step(state, _):
        values = F.transform("pool", lambda c, i: value(c, i, state))
        pick = (F.array_position(values, F.array_max(values)) - 1).cast("int")
        chosen = F.get(F.col("pool"), pick)
        near = F.transform("pool", lambda c, i: F.greatest(
            F.get(state["near"], i), V.dot(c["vec"], chosen["vec"])))
        taken = F.array_append(state["taken"], pick)
        return F.struct(taken.alias("taken"), near.alias("near"))

    # The first pick has no rows to differ from; -1 is the least cosine, equal for all rows.
    start = F.struct(F.array().cast("array<int>").alias("taken"),
                     F.transform("pool", lambda c: F.lit(-1.0)).alias("near"))
    steps = F.sequence(F.lit(1), F.least(F.lit(k), F.size("pool")))
    folded = pool.where(F.size("pool") > 0).withColumn(
        "taken", F.aggregate(steps, start, step)["taken"])
    picks = folded.select("query_id", "pool", F.posexplode("taken").alias("pos", "at"))
    return picks.select("query_id", F.get("pool", F.col("at"))["id"].alias("id"),
                        (F.col("pos") + 1).alias("rank"),
                        F.get("pool", F.col("at"))["score"].alias("score"))


def nearest_diverse(queries: DataFrame, corpus: DataFrame, k: int = 3, fetch_k: int = 5,
                    trade_off: float = 0.5, id: str = "id", vec: str = "embedding",
                    **options) -> DataFrame:
    """Fetch ``fetch_k`` rows by similarity, keep ``k`` diverse ones."""
    found = similar(queries, corpus, fetch_k, id=id, vec=vec, **options)
    vectors = [id_column(corpus, id).alias("id"), F.col(vec).alias("embedding")]
    return mmr(rows_of(found, corpus, vectors, few_rows(queries, fetch_k)), k, trade_off)


def multi_query(variants: DataFrame, corpus: DataFrame, k: int = 2, vec: str = "embedding",
                **options) -> DataFrame:
    """Top-k for every rewrite ``(query_id, variant_no, vec)``; distinct union per query.

    A row found by several rewrites keeps its best score and is returned once.
    """
    keyed = variants.withColumn("_rewrite", F.struct("query_id", "variant_no"))
    found = similar(keyed, corpus, k, query_id="_rewrite", query_vec=vec, vec=vec, **options)
    per_query = found.withColumn("query_id", F.col("query_id.query_id"))
    return per_query.groupBy("query_id", "id").agg(
        F.max("score").alias("score"), F.count(F.lit(1)).alias("n_variants"))


def parents_of(ranked_children: DataFrame) -> DataFrame:
    """Distinct parents of retrieved children, in best-child order.

    Child ids are structs ``(doc_id, parent_no, child_no)``, so no join is needed.
    """
    owner = ranked_children.select("query_id", "id.doc_id", "id.parent_no", "rank", "score")
    hits = owner.groupBy("query_id", "doc_id", "parent_no").agg(
        F.min("rank").alias("best_child_rank"), F.max("score").alias("score"))
    return with_rank(hits, ["query_id"], [F.asc("best_child_rank"), F.asc("doc_id"), F.asc("parent_no")])


def parent_search(queries: DataFrame, docs: DataFrame, k: int = 4, *, id: str = "doc_id",
                  text: str = "text", query_id: str = "query_id", query: str = "query",
                  parent=(600, 50), child=(150, 15), dim: int = DIM) -> DataFrame:
    """Search small children, return the larger parents they come from.

    Only documents with a hit are split a second time to get the parent texts.
    """
    corpus = spread(docs.select(id, text), id)
    _, children = parent_child(corpus, id, text, parent, child)
    found = similar(queries.select(F.col(query_id).alias("query_id"), signature(query, dim).alias("codes")),
                    children.select(F.struct("doc_id", "parent_no", "child_no").alias("child_id"), signature("child", dim).alias("codes")), k,
                    query_vec="codes", id="child_id", vec="codes", encoding="signature", dim=dim)
    placed = materialise(parents_of(found))
    hit_docs = placed.select(F.col("doc_id").alias(id)).distinct()
    small = few_rows(queries, k)
    needed = docs.select(id, text).join(F.broadcast(hit_docs) if small else hit_docs, id, "left_semi")
    parents, _ = parent_child(needed, id, text, parent, child)
    return (F.broadcast(placed) if small else placed).join(parents, ["doc_id", "parent_no"])


def distinct_sources(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """First-seen order of distinct keys within each query's ranked rows."""
    first = ranked.groupBy("query_id", *keys).agg(F.min("rank").alias("first_rank"))
    return with_rank(first, ["query_id"],
                     [F.asc("first_rank"), *[F.asc(c) for c in keys]], rank="source_no")


def with_small_table(df: DataFrame, dimension: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a dimension table, broadcast only behind its size check."""
    return df.join(broadcast_if_small(dimension), on, how)
