"""BM25 (Robertson & Zaragoza 2009; non-negative idf as in Kamphuis et al. 2020).

The corpus is read in place. Term counts are combined in each task before their shuffle, and the
query terms that pass a size check are sent to the documents: a task adds up the scores of a tile
of documents and returns its own best ``k`` rows per query, so neither tokens nor (query,
document) pairs are shuffled. Larger query tables are joined with the postings on salted terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..plans.blockjoin import SCHEMA, TILE_CELLS, BestRows, Scoring
from ..plans.ranking import explode_list, top_k
from ..plans.sizing import fits_broadcast, materialise, spread

K1 = 1.5
B = 0.75
MAX_QUERIES_SENT = 50_000
MAX_QUERY_CHARS_SENT = 8_000_000
SALTS = 64


def index_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, terms, n_terms)``; the base of every other sparse table."""
    rows = spread(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "id")
    return rows.select("id", tokens("text").alias("terms")).withColumn("n_terms", F.size("terms"))


def postings(index: DataFrame) -> DataFrame:
    """``(id, n_terms, term, tf)``, placed by document."""
    return (explode_list(index.repartition("id"), ["id", "n_terms"], "terms", "term")
            .groupBy("id", "n_terms", "term").agg(F.count(F.lit(1)).alias("tf")))


def term_stats(index: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(term, df)``: in how many documents a term occurs.

    ``only`` is a small table of wanted terms; other tokens are dropped as they are read.
    """
    seen = explode_list(index, [], F.array_distinct("terms"), "term")
    if only is not None:
        seen = seen.join(F.broadcast(only.select("term").distinct()), "term", "left_semi")
    return seen.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(index: DataFrame) -> DataFrame:
    """One row ``(n_docs, sum_terms)``; additive over batches of documents."""
    return index.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_terms").alias("sum_terms"))


def wanted_stats(index: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``term_stats`` of the wanted terms and ``corpus_stats``, from one pass over the corpus.

    Each document adds one null term that carries its length.
    """
    known_terms = F.coalesce(F.array_distinct("terms"), F.array().cast("array<string>"))  # a null text is a document too
    marked = explode_list(index, ["n_terms"], F.array_append(known_terms, F.lit(None).cast("string")), "term")
    known = F.broadcast(wanted.select("term").distinct().withColumn("hit", F.lit(True)))
    kept = marked.join(known, "term", "left").where(F.col("hit") | F.col("term").isNull())
    counts = materialise(kept.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("n_terms").alias("sum_terms")))
    totals = counts.where(F.col("term").isNull()).agg(
        F.coalesce(F.sum("df"), F.lit(0)).alias("n_docs"), F.sum("sum_terms").alias("sum_terms"))
    return counts.where(F.col("term").isNotNull()).select("term", "df"), totals


def merge_stats(*parts: DataFrame) -> DataFrame:
    """Add up ``term_stats`` tables of disjoint document batches."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy("term").agg(F.sum("df").alias("df"))


def merge_corpus_stats(*parts: DataFrame) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.agg(F.sum("n_docs").alias("n_docs"), F.sum("sum_terms").alias("sum_terms"))


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "query") -> DataFrame:
    """``(query_id, term, qtf)``; a term repeated in a query counts each time."""
    exploded = explode_list(queries, [F.col(query_id).alias("query_id")], tokens(text), "term")
    return exploded.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def _idf(df, n):
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def _saturation(tf, n_terms, avg_terms):
    return (tf * (K1 + 1.0)) / (tf + K1 * (1.0 - B + B * n_terms / avg_terms))


def _send_terms(weighted: DataFrame, index: DataFrame, k: int, avg_terms: float) -> DataFrame:
    """Best ``k`` documents per query and task, from weights ``(query_id, term, weight)``."""
    table = weighted.toArrow().sort_by("term").combine_chunks()
    query_ids, query_at = np.unique(table.column("query_id").to_numpy(), return_inverse=True)
    terms = table.column("term")
    vocabulary = pc.unique(terms)
    term_at = pc.index_in(terms, value_set=vocabulary).to_numpy()
    starts = np.searchsorted(term_at, np.arange(len(vocabulary) + 1))
    sent = index.sparkSession.sparkContext.broadcast(
        (query_ids, vocabulary, starts, query_at, table.column("weight").to_numpy()))

    def tile(codes, owner, n_terms):
        """Scores of a few documents against all queries."""
        query_ids, vocabulary, starts, query_at, weights = sent.value
        width = len(n_terms)
        pair, tf = np.unique(owner * len(vocabulary) + codes, return_counts=True)
        doc, code = pair // len(vocabulary), pair % len(vocabulary)
        part = _saturation(tf, n_terms[doc], avg_terms)
        counts = starts[code + 1] - starts[code]
        ends = np.cumsum(counts)
        scores = np.zeros(len(query_ids) * width)
        # A frequent term meets many queries, so its products are added up a bounded run at a time.
        at = 0
        while at < len(code):
            done = ends[at - 1] if at else 0
            end = max(int(np.searchsorted(ends, done + TILE_CELLS, side="right")), at + 1)
            n = counts[at:end]
            place = np.repeat(starts[code[at:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            flat = query_at[place] * width + np.repeat(doc[at:end], n)
            scores += np.bincount(flat, weights[place] * np.repeat(part[at:end], n), len(scores))
            at = end
        scores = np.round(scores.reshape(len(query_ids), width), 6)
        scores[scores <= 0.0] = -np.inf
        return scores

    def task(batches):
        query_ids, vocabulary = sent.value[:2]
        best = BestRows(len(query_ids), k)
        step = max(TILE_CELLS // max(len(query_ids), 1), 1)
        for batch in batches:
            if not batch.num_rows or not len(query_ids):
                continue
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            column = batch.column("terms")
            n_terms = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            codes = pc.index_in(column.flatten(), value_set=vocabulary).fill_null(-1)
            codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(ids)), n_terms)
            owner, codes = owner[codes >= 0], codes[codes >= 0]
            for at in range(0, len(ids), step):
                low, high = np.searchsorted(owner, [at, at + step])
                best.add(tile(codes[low:high], owner[low:high] - at, n_terms[at:at + step]),
                         ids[at:at + step])
        yield best.rows(Scoring(k=k), query_ids)

    found = index.select(F.col("id").cast("bigint").alias("id"), "terms").mapInArrow(task, SCHEMA)
    return found.drop("rank")


def bm25(queries: DataFrame, docs: DataFrame, k: int, *, id: str = "doc_id", text: str = "text",
         query_id: str = "query_id", query: str = "query", index: DataFrame | None = None,
         stats: DataFrame | None = None, totals: DataFrame | None = None,
         send_limit: int = MAX_QUERIES_SENT) -> DataFrame:
    """Top-k documents per query with a positive score."""
    index = index_documents(docs, id, text) if index is None else index
    wanted = query_terms(queries, query_id, query)
    # A query has fewer distinct terms than characters, so its text bounds the rows to send.
    small = fits_broadcast(queries, f"length(`{query}`)", send_limit, MAX_QUERY_CHARS_SENT)
    if small and stats is None and totals is None:
        stats, totals = wanted_stats(index, wanted)
    stats = term_stats(index, wanted if small else None) if stats is None else stats
    totals = corpus_stats(index) if totals is None else totals
    wanted = F.broadcast(wanted) if small else wanted
    n_docs, sum_terms = totals.first()
    avg_terms = float(sum_terms or 1) / max(n_docs, 1)
    weighted = stats.join(wanted, "term").select(
        F.col("query_id").cast("bigint").alias("query_id"), "term",
        (F.col("qtf") * _idf(F.col("df"), F.lit(float(n_docs)))).alias("weight"))
    if small:
        scored = _send_terms(weighted, index, k, avg_terms)
    else:
        # A frequent term is spread over salts by document; its query rows are copied to each.
        salted = postings(index).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        copies = weighted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        matched = salted.join(copies.withColumn("salt", F.col("salt").cast("bigint")), ["term", "salt"])
        part = F.col("weight") * _saturation(F.col("tf").cast("double"), F.col("n_terms"), avg_terms)
        scored = (matched.groupBy("id", "query_id").agg(F.round(F.sum(part), 6).alias("score"))
                  .where(F.col("score") > 0))
    ranked = top_k(scored, k, ["query_id"], [F.desc("score"), F.asc("id")])
    return ranked.select("query_id", "id", "rank", "score")
