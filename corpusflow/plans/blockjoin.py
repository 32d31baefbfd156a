"""Similarity joins evaluated block by block, so that pairs are never rows.

Three plans give the same result:

* the query side passes a size check: it is sent to every task once, the corpus is read in place
  and each task returns only its own best ``k`` rows per query;
* the corpus is known to be small (index centres, a small cache): it is sent instead, and each
  task finishes its own queries without a shuffle;
* otherwise both sides are cut into blocks of bounded size (the fragment-and-replicate grid of
  Okcan & Riedewald 2011) and each pair of blocks is one small group. Groups named by ``by`` (a
  tenant, a cell of an index) are cut the same way, so one hot group becomes many tasks.

Inside a task the scores of a block are one matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.embed import DIM, expand, list_parts
from .ranking import top_k
from .sizing import broadcast_if_small, fits_broadcast, materialise

QUERY_ROWS = 4096
CORPUS_ROWS = 16384
MAX_QUERIES_SENT = 8192
TILE_CELLS = 1_000_000
BATCH_ROWS = 2048  # rows of a batch made dense at a time
CELLS = 48         # pairs of blocks that keep the cores busy; blocks grow until there are about so many
BLOCK_BYTES = 16 * 1024 * 1024
NONE = -np.inf
SCHEMA = "query_id bigint, id bigint, score double, rank int"


@dataclass(frozen=True)
class Scoring:
    """How two vectors are compared. Higher scores are better; ``l2`` scores are negative."""

    metric: str = "dot"
    encoding: str = "dense"
    dim: int = DIM
    k: int | None = None
    min_score: float | None = None
    exclude_self: bool = False
    earlier_only: bool = False
    query_type: pa.DataType = pa.int64()
    id_type: pa.DataType = pa.int64()

    def matrix(self, column) -> np.ndarray:
        values, starts = list_parts(column)
        if self.encoding == "signature":
            return expand(values, starts, self.dim)
        rows = len(starts) - 1
        dense = values.astype(np.float64).reshape(rows, -1 if rows else 0)
        if self.metric == "cosine" and rows:
            length = np.sqrt(np.einsum("ij,ij->i", dense, dense))
            length[length == 0.0] = 1.0
            dense = dense / length[:, None]
        return dense

    def scores(self, queries: np.ndarray, corpus: np.ndarray) -> np.ndarray:
        out = queries @ corpus.T
        if self.metric == "l2":
            q = np.einsum("ij,ij->i", queries, queries)
            c = np.einsum("ij,ij->i", corpus, corpus)
            out = -np.maximum(q[:, None] + c[None, :] - 2.0 * out, 0.0)
        return np.round(out, 6) + 0.0


def _sortable(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids; places without a row hold no id yet."""
    if ids.dtype != object:
        return ids
    out = np.zeros(len(ids), np.int64)
    real = scores > NONE
    out[real] = np.unique(ids[real], return_inverse=True)[1]
    return out


class BestRows:
    """Best ``k`` (score desc, id asc) per query over all tiles seen so far."""

    def __init__(self, rows: int, k: int, integers: bool = True):
        self.k = k
        self.scores = np.full((rows, k), NONE)
        self.ids = np.full((rows, k), np.iinfo(np.int64).max if integers else None)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        rows, width = scores.shape
        bound = self.scores[:, -1]
        if width > self.k and np.isneginf(bound).any():
            bound = np.maximum(bound, np.partition(scores, width - self.k, axis=1)[:, width - self.k])
        r, c = np.nonzero((scores >= bound[:, None]) & (scores > NONE))
        if not len(r):
            return
        owner = np.concatenate([np.repeat(np.arange(rows), self.k), r])
        value = np.concatenate([self.scores.ravel(), scores[r, c]])
        ident = np.concatenate([self.ids.ravel(), ids[c]])
        order = np.lexsort((_sortable(ident, value), -value, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, np.arange(rows))[owner]
        kept = order[place < self.k]
        self.scores = value[kept].reshape(rows, self.k)
        self.ids = ident[kept].reshape(rows, self.k)

    def rows(self, how: Scoring, query_ids: np.ndarray):
        r, c = np.nonzero(self.scores > NONE)
        return _rows(how, query_ids[r], self.ids[r, c], self.scores[r, c], c + 1)


def _rows(how: Scoring, query_ids, ids, scores, ranks=None) -> pa.RecordBatch:
    ranks = np.zeros(len(ids)) if ranks is None else ranks
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids, how.query_type), pa.array(ids, how.id_type), pa.array(scores, pa.float64()),
         pa.array(np.asarray(ranks).astype(np.int32))],
        names=["query_id", "id", "score", "rank"])


def _masked(how: Scoring, query_ids, queries, ids, corpus) -> np.ndarray:
    scores = how.scores(queries, corpus)
    drop = None
    if how.min_score is not None:
        drop = scores < how.min_score
    if how.exclude_self:
        same = query_ids[:, None] == ids[None, :]
        drop = same if drop is None else drop | same
    if how.earlier_only:
        late = ids[None, :] >= query_ids[:, None]
        drop = late if drop is None else drop | late
    if drop is not None:
        scores[drop] = NONE
    return scores


def _compare(how: Scoring, query_ids: np.ndarray, queries: np.ndarray, blocks):
    """Score queries against a stream of ``(ids, matrix)`` blocks."""
    step_q = min(len(query_ids), QUERY_ROWS) or 1
    step_c = max(TILE_CELLS // step_q, 1)
    spans = [slice(a, a + step_q) for a in range(0, len(query_ids), step_q)]
    best = [BestRows(len(query_ids[s]), how.k, how.id_type == pa.int64()) for s in spans] if how.k else None
    for ids, corpus in blocks:
        for at in range(0, len(ids), step_c):
            part_ids, part = ids[at:at + step_c], corpus[at:at + step_c]
            for n, span in enumerate(spans):
                scores = _masked(how, query_ids[span], queries[span], part_ids, part)
                if best:
                    best[n].add(scores, part_ids)
                else:
                    r, c = np.nonzero(scores > NONE)
                    yield _rows(how, query_ids[span][r], part_ids[c], scores[r, c])
    if best:
        for n, span in enumerate(spans):
            yield best[n].rows(how, query_ids[span])


def _read(how: Scoring, table, ident: str):
    """Ids and vectors of the rows that have a vector."""
    vec = table.column("vec")
    if vec.null_count:
        table = table.filter(vec.is_valid())
    return _ids(table.column(ident)), how.matrix(table.column("vec"))


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Integers as such; strings, and structs as tuples, as objects that sort like the column."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    if pa.types.is_integer(column.type):
        return np.concatenate([np.zeros(0, np.int64), *[p.to_numpy(zero_copy_only=False) for p in parts]])
    out, at = np.empty(len(column), object), 0
    for part in parts:
        values = zip(*[f.to_pylist() for f in part.flatten()]) if pa.types.is_struct(part.type) else part.to_pylist()
        for value in values:
            out[at], at = value, at + 1
    return out


def id_column(df: DataFrame, name: str):
    """Ids are strings, structs or integers; integers of any width are compared as bigint."""
    own = isinstance(df.select(name).schema[0].dataType, (T.StringType, T.StructType))
    return F.col(name) if own else F.col(name).cast("bigint")


def _schema(queries: DataFrame, corpus: DataFrame) -> str:
    query, ident = (df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (corpus, "id")))
    return f"query_id {query}, id {ident}, score double, rank int"


def _send_queries(queries: DataFrame, corpus: DataFrame, how: Scoring) -> DataFrame:
    table = queries.toArrow()
    sent = queries.sparkSession.sparkContext.broadcast(_read(how, table, "query_id"))

    def task(batches):
        query_ids, matrix = sent.value
        blocks = (_read(how, b.slice(at, BATCH_ROWS), "id") for b in batches for at in range(0, b.num_rows, BATCH_ROWS))
        yield from _compare(how, query_ids, matrix, blocks)

    return corpus.mapInArrow(task, _schema(queries, corpus))


def _send_corpus(queries: DataFrame, corpus: DataFrame, how: Scoring) -> DataFrame:
    sent = corpus.sparkSession.sparkContext.broadcast(_read(how, corpus.toArrow(), "id"))

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield from _compare(how, *_read(how, batch.slice(at, BATCH_ROWS), "query_id"), [sent.value])

    return queries.mapInArrow(task, _schema(queries, corpus))


def _compared(how: Scoring, left: pa.Table, right: pa.Table):
    return _compare(how, *_read(how, left, "query_id"), [_read(how, right, "id")])


def _block_rows(groups: DataFrame, dim: int) -> tuple[int, int]:
    """Rows of a query block and of a corpus block.

    Every row goes to as many cells as the other side has blocks, so blocks grow with the tables,
    up to what a task holds.
    """
    pairs, width = groups.agg(F.sum(F.col("_nq").cast("double") * F.col("_nc")), F.max("_dim")).first()
    side = min(int(((pairs or 0.0) / CELLS) ** 0.5), BLOCK_BYTES // (8 * max(width or dim, 1)))
    return max(QUERY_ROWS, side), max(CORPUS_ROWS, side)


def _grid(queries: DataFrame, corpus: DataFrame, by: list[str], how: Scoring, compare=None) -> DataFrame:
    # New column identities: both sides may come from one table.
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
    corpus = corpus.select(*[F.col(c).alias(c) for c in corpus.columns])
    dim = F.lit(how.dim) if how.encoding == "signature" else F.max(F.size("vec"))

    def sizes(df, name):
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name), dim.alias(f"{name}_dim"))

    groups = materialise(sizes(queries, "_nq").join(sizes(corpus, "_nc"), by, "full").withColumn("_dim", F.greatest("_nq_dim", "_nc_dim")))
    query_rows, corpus_rows = _block_rows(groups, how.dim)
    cut = lambda n, rows: F.ceil(F.col(n) / F.lit(rows)).cast("int")
    # Only groups of more than one block are listed, so the list is at most rows / block long.
    cuts = groups.select(*by, cut("_nq", query_rows).alias("_qs"), cut("_nc", corpus_rows).alias("_cs"))
    cuts = broadcast_if_small(materialise(cuts.where("_qs > 1 OR _cs > 1")))

    def cells(df, ident, own, other):
        one = F.lit(1)
        return (df.join(cuts, by, "left")
                .withColumn(f"{own}b", F.pmod(F.xxhash64(ident), F.coalesce(F.col(f"{own}s"), one)).cast("int"))
                .withColumn(f"{other}b", F.explode(F.sequence(
                    F.lit(0), F.coalesce(F.col(f"{other}s"), one) - 1)))
                .drop("_qs", "_cs"))

    keys = [*by, "_qb", "_cb"]

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = list((compare or _compared)(how, left, right))
        return pa.Table.from_batches(found or [_rows(how, [], [], [])])

    return (cells(queries, "query_id", "_q", "_c").groupBy(*keys)
            .cogroup(cells(corpus, "id", "_c", "_q").groupBy(*keys))
            .applyInArrow(task, _schema(queries, corpus)))


def similar(queries: DataFrame, corpus: DataFrame, k: int | None = None, *,
            query_id: str = "query_id", query_vec: str = "embedding", id: str = "id",
            vec: str = "embedding", by: list[str] | None = None, metric: str = "dot",
            encoding: str = "dense", dim: int = DIM, min_score: float | None = None,
            exclude_self: bool = False, earlier_only: bool = False,
            send_limit: int = MAX_QUERIES_SENT, small_corpus: bool = False,
            repeated: bool = False) -> DataFrame:
    """Exact ``(query_id, id, score[, rank])`` of each query's best ``k`` corpus rows.

    ``k=None`` returns every score, for matrices and full rankings. ``by`` restricts matches to
    equal values of the named columns. ``earlier_only`` keeps corpus ids below the query id.
    ``small_corpus`` asks to send the corpus, which is done when its size check holds. Ids are
    integers, strings or structs of them (a chunk's document and number); ties go by their order.
    ``repeated`` says that a pair may meet in several groups; it then counts once.
    """
    by = list(by or [])
    how = Scoring(metric, encoding, dim, k, min_score, exclude_self, earlier_only)
    # Rows without a vector are dropped inside the tasks: a filter here would be pushed down and
    # compute a derived vector twice.
    left = queries.select(
        id_column(queries, query_id).alias("query_id"), F.col(query_vec).alias("vec"), *by)
    right = corpus.select(id_column(corpus, id).alias("id"), F.col(vec).alias("vec"), *by)
    how = replace(how, query_type=to_arrow_type(left.schema["query_id"].dataType),
                  id_type=to_arrow_type(right.schema["id"].dataType))
    width = "8 * size(vec) + 64"
    if not by and small_corpus and fits_broadcast(right, width, MAX_QUERIES_SENT):
        scored = _send_corpus(left, right, how)
        return scored.select("query_id", "id", *(["rank"] if k else []), "score")
    if not by and fits_broadcast(left, width, send_limit):
        scored = _send_queries(left, right, how)
    else:
        if not by:
            left, right, by = (left.withColumn("_all", F.lit(0)),
                               right.withColumn("_all", F.lit(0)), ["_all"])
        scored = _grid(left, right, by, how)
    scored = scored.drop("rank")  # the rank inside one task or block
    if repeated:
        scored = scored.dropDuplicates(["query_id", "id"])
    if k is None:
        return scored
    ranked = top_k(scored, k, ["query_id"], [F.desc("score"), F.asc("id")])
    return ranked.select("query_id", "id", "rank", "score")
