"""Weighted reciprocal rank fusion (Cormack et al. 2009) of any number of ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embed import DIM, signature
from ..functions.text import text_key
from ..plans.blockjoin import similar
from ..plans.ranking import top_k, with_rank
from ..plans.sizing import few_rows, rows_of, spread
from .inverted import TextIndex
from .sparse import bm25

RRF_CONSTANT = 60


def fuse(lists: list[DataFrame], weights: list[float], docs: DataFrame, k: int | None = None, *,
         constant: int = RRF_CONSTANT, first_rank: int = 0, id: str = "doc_id",
         text: str = "text", small: bool = False) -> DataFrame:
    """Sum of ``weight / (rank + constant)`` per query and document text.

    Equal texts are one document: their scores add up, also inside one list, and the first seen
    row gives the id. ``first_rank`` is the rank base inside the formula. One shuffle on
    (query, text) replaces an outer join of the lists. Texts are hashed before they meet the
    lists; ``docs`` with a column ``text_key`` (a stored index) are not hashed again. ``small`` as
    in ``rows_of``.
    """
    key = F.col("text_key") if "text_key" in docs.columns else text_key(text).alias("text_key")
    parts = [
        ranked.select("query_id", "id", F.lit(n).alias("list_no"), "rank",
                      (F.lit(float(w)) / (F.col("rank") - 1 + first_rank + constant)).alias("part"))
        for n, (ranked, w) in enumerate(zip(lists, weights, strict=True))]
    union = reduce(DataFrame.unionByName, parts)
    keyed = rows_of(union, docs, [F.col(id).alias("id"), key], small)
    fused = keyed.groupBy("query_id", "text_key").agg(
        F.min_by("id", F.struct("list_no", "rank")).alias("id"),
        F.round(F.sum("part"), 9).alias("score")).drop("text_key")
    order = [F.desc("score"), F.asc("id")]
    if k is None:
        ranked = with_rank(fused, ["query_id"], order)
    else:
        ranked = top_k(fused, k, ["query_id"], order)
    return ranked.select("query_id", "id", "rank", "score")


def dense_text_search(queries: DataFrame, docs: DataFrame, k: int, *, id: str = "doc_id",
                      text: str = "text", query_id: str = "query_id", query: str = "query",
                      dim: int = DIM, **options) -> DataFrame:
    """Dense top-k from raw text. Signatures go to the block join, which adds them up there."""
    coded = spread(docs.select(id, text), id).select(
        F.col(id).alias("id"), signature(text, dim).alias("codes"))
    return search_codes(queries, coded, k, query_id=query_id, query=query, dim=dim, **options)


def search_codes(queries: DataFrame, coded: DataFrame, k: int, *, query_id: str = "query_id",
                 query: str = "query", dim: int = DIM, **options) -> DataFrame:
    """Dense top-k over ``(id, codes)``, the stored signatures of documents or chunks."""
    left = queries.select(F.col(query_id).alias("query_id"), signature(query, dim).alias("codes"))
    return similar(left, coded, k, query_vec="codes", vec="codes", encoding="signature", dim=dim, **options)


def _legs(queries: DataFrame, docs: DataFrame, k: int, dim: int, index: TextIndex | None):
    """BM25 and dense lists of ``k`` rows each, and the rows that tell equal texts."""
    if index is None:
        return [bm25(queries, docs, k), dense_text_search(queries, docs, k, dim=dim)], docs, "doc_id"
    rows = index.docs()
    return [index.search(queries, k), search_codes(queries, rows.select("id", "codes"), k, dim=dim)], rows, "id"


def hybrid_search(queries: DataFrame, docs: DataFrame, k: int = 4, bm25_weight: float = 0.5,
                  dim: int = DIM, index: TextIndex | None = None) -> DataFrame:
    """BM25 and dense lists of ``k`` rows each, fused with weights ``w`` and ``1 - w``.

    With a stored ``index`` of ``docs`` no text is read.
    """
    lists, rows, id = _legs(queries, docs, k, dim, index)
    return fuse(lists, [bm25_weight, 1.0 - bm25_weight], rows, k, id=id, small=few_rows(queries, 2 * k))


def ensemble_search(queries: DataFrame, docs: DataFrame, k: int = 2, weights=(0.4, 0.6),
                    dim: int = DIM, index: TextIndex | None = None) -> DataFrame:
    """Two legs of ``k`` rows, 1-based ranks in the formula, nothing cut from the fused list."""
    lists, rows, id = _legs(queries, docs, k, dim, index)
    return fuse(lists, list(weights), rows, None, first_rank=1, id=id, small=few_rows(queries, 2 * k))
