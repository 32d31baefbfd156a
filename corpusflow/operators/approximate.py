"""Approximate vector search by signed random projections (Charikar 2002) with multi-probe.

A vector's code in a hash table is the side of each of a few hyperplanes on which it lies. The
planes follow from a rule, so an index needs no training and any part of it can be built alone:
they are rows of a Hadamard matrix, orthogonal to each other, with the dimensions' signs mixed. A
query looks into a fixed number of codes of every table, in order of what it costs to flip its
own: the sum of its squared distances to the planes that would have to lie on the other side (Lv
et al. 2007; the planes being orthogonal, that sum bounds the cosine to anything in there).

The index keeps each vector once, with its codes. Queries that pass a size check go to the index,
which is read in place, and a task multiplies the rows of a code only with the queries that look
into it. Beyond the check both sides meet as blocks of bounded size, and a pair of blocks is handled
in the same way.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.embed import list_parts
from ..plans.blockjoin import MAX_QUERIES_SENT, BestRows, Scoring, _grid, _ids, _rows, _schema, id_column
from ..plans.ranking import top_k
from ..plans.sizing import fits_broadcast, spread

TABLES = 6
BITS = 8     # planes of a table
PROBES = 32  # codes of a table that a query looks into
CELL_QUERIES = 2048  # queries of a block whose codes are ranked at once


def planes(dim: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """``tables * bits`` rows of signs: the parity of the bits that plane and dimension share."""
    number, place = np.arange(1, tables * bits + 1)[:, None], np.arange(dim)[None, :]
    parity = np.bitwise_count(number & place) & 1
    return (1 - 2.0 * parity) * (1 - 2.0 * ((((place + 1) * 40503) >> 7) & 1))


def _sides(matrix: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Rounded signed distances to all planes, as rows x tables x bits."""
    z = np.round(matrix @ planes(matrix.shape[1], tables, bits).T, 6) + 0.0
    return z.reshape(len(matrix), tables, bits)


def codes_of(matrix: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """Code of each row in each table."""
    return ((_sides(matrix, tables, bits) >= 0) << np.arange(bits)).sum(axis=2)


def probes_of(matrix: np.ndarray, probes: int = PROBES, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """The ``probes`` codes of each table that are the cheapest to reach, cheapest first."""
    z = _sides(matrix, tables, bits)
    flips = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    cost = np.round(np.square(z) @ flips.T, 6)
    cheapest = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]  # ties by the flipped bits
    own = ((z >= 0) << np.arange(bits)).sum(axis=2)
    return own[:, :, None] ^ cheapest


def _vectors(column) -> np.ndarray:
    values, starts = list_parts(column)
    rows = len(starts) - 1
    return values.astype(np.float64).reshape(rows, -1 if rows and len(values) else 0)


def _numbers(pick, per_row: int):
    """Arrow function from vectors to a fixed number of integers each; null for a missing vector."""
    @F.arrow_udf("array<int>")
    def out(column: pa.Array) -> pa.Array:
        there = column.is_valid().to_numpy(zero_copy_only=False)
        found = np.zeros((len(column), per_row), np.int32)
        if there.any():
            found[there] = pick(_vectors(column.filter(pa.array(there)))).reshape(there.sum(), per_row)
        ends = pa.array(np.arange(len(column) + 1, dtype=np.int32) * per_row)
        return pa.ListArray.from_arrays(ends, pa.array(found.ravel()), mask=pa.array(~there))

    return out


def index_vectors(corpus: DataFrame, id: str = "id", vec: str = "embedding", tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """``(id, embedding, codes)``: the index, one row per vector, to be stored and appended to."""
    rows = spread(corpus.select(F.col(id).alias("id"), F.col(vec).alias("embedding")), "id")
    return rows.withColumn("codes", _numbers(lambda m: codes_of(m, tables, bits), tables)("embedding"))


def _add(best: BestRows, owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Merge found ``(query place, score, id)`` triples, each pair at most once, into the best rows."""
    k, rows = best.k, len(best.scores)
    held_owner, held = np.repeat(np.arange(rows), k), best.scores.ravel() > -np.inf
    owner = np.concatenate([held_owner[held], owner])
    scores = np.concatenate([best.scores.ravel()[held], scores])
    ids = np.concatenate([best.ids.ravel()[held], ids])
    names = ids if ids.dtype != object else np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((names, -scores, owner))
    owner, scores, ids, names = owner[order], scores[order], ids[order], names[order]
    # A pair found through several tables has one score, so its rows are neighbours.
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
    owner, scores, ids = owner[first], scores[first], ids[first]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    kept = place < k
    best.scores[:], best.ids[:] = -np.inf, (np.iinfo(np.int64).max if best.ids.dtype != object else None)
    best.scores[owner[kept], place[kept]] = scores[kept]
    best.ids[owner[kept], place[kept]] = ids[kept]


def _lookers(matrix: np.ndarray, probes: int, tables: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each (table, code) the queries that look into it: their places, and where each code's begin."""
    asked = probes_of(matrix, probes, tables, bits) if len(matrix) else np.zeros((0, tables, probes), np.int64)
    key = (np.arange(tables)[None, :, None] << bits | asked).ravel()
    order = np.argsort(key, kind="stable")
    return (order // (tables * asked.shape[2] or 1)).astype(np.int32), np.searchsorted(key[order], np.arange((tables << bits) + 1))


def _look(best: BestRows, how: Scoring, queries: tuple, ids: np.ndarray, rows: np.ndarray, codes: np.ndarray, tables: int, bits: int) -> None:
    """Merge the rows that the queries ``(ids, matrix, *lookers)`` find into the best ones."""
    query_ids, matrix, lookers, bounds = queries
    for t in range(tables):
        by_code = np.argsort(codes[:, t], kind="stable")
        cuts = np.searchsorted(codes[by_code, t], np.arange((1 << bits) + 1))
        owner, score, ident = [], [], []
        for code, (a, b) in enumerate(pairwise(cuts)):
            mine = lookers[bounds[t << bits | code]:bounds[(t << bits | code) + 1]]
            if a == b or not len(mine):
                continue
            at = by_code[a:b]
            found = how.scores(matrix[mine], rows[at])
            bound, most = best.scores[mine, -1], how.k + how.exclude_self
            if b - a > most:  # rows past the best of a code cannot be among the best
                bound = np.maximum(bound, np.partition(found, b - a - most, axis=1)[:, b - a - most])
            keep = found >= bound[:, None]
            if how.exclude_self:
                keep &= query_ids[mine][:, None] != ids[at][None, :]
            r, c = np.nonzero(keep)
            owner.append(mine[r])
            score.append(found[r, c])
            ident.append(ids[at[c]])
        if owner:
            _add(best, np.concatenate(owner), np.concatenate(score), np.concatenate(ident))


def _send(queries: DataFrame, index: DataFrame, how: Scoring, probes: int, tables: int, bits: int) -> DataFrame:
    """Queries to every task; a task returns its own best ``k`` rows per query."""
    got = queries.toArrow()
    got = got.filter(got.column("vec").is_valid())
    query_ids, matrix = _ids(got.column("query_id")), _vectors(got.column("vec"))
    sent = index.sparkSession.sparkContext.broadcast((query_ids, matrix, *_lookers(matrix, probes, tables, bits)))

    def task(batches):
        query_ids = sent.value[0]
        best = BestRows(len(query_ids), how.k, how.id_type == pa.int64())
        for batch in batches:
            batch = batch.filter(batch.column("vec").is_valid())
            if batch.num_rows and len(query_ids):
                codes = list_parts(batch.column("codes"))[0].reshape(batch.num_rows, tables)
                _look(best, how, sent.value, _ids(batch.column("id")), _vectors(batch.column("vec")), codes, tables, bits)
        yield best.rows(how, query_ids) if len(query_ids) else _rows(how, [], [], [])

    return index.mapInArrow(task, _schema(queries, index))


def _cells(queries: DataFrame, index: DataFrame, how: Scoring, probes: int, tables: int, bits: int) -> DataFrame:
    """Blocks of queries meet blocks of the index; a pair of blocks returns its own best ``k`` rows per query."""
    def look(how, left, right):
        ids, rows = _ids(right.column("id")), _vectors(right.column("vec"))
        codes = list_parts(right.column("codes"))[0].reshape(len(ids), tables)
        for at in range(0, left.num_rows, CELL_QUERIES):
            part = left.slice(at, CELL_QUERIES)
            query_ids, matrix = _ids(part.column("query_id")), _vectors(part.column("vec"))
            best = BestRows(len(query_ids), how.k, how.id_type == pa.int64())
            _look(best, how, (query_ids, matrix, *_lookers(matrix, probes, tables, bits)), ids, rows, codes, tables, bits)
            yield best.rows(how, query_ids)

    left, right = (df.where("vec IS NOT NULL").withColumn("_all", F.lit(0)) for df in (queries, index))
    return _grid(left, right, ["_all"], how, look)


def nearest_approximate(queries: DataFrame, index: DataFrame, k: int, probes: int = PROBES, *, tables: int = TABLES, bits: int = BITS,
                        query_id: str = "query_id", vec: str = "embedding", exclude_self: bool = False,
                        send_limit: int = MAX_QUERIES_SENT) -> DataFrame:
    """Best ``k`` rows per query among those whose code it looks into, by exact dot product.

    ``index`` is a table made by ``index_vectors`` with the same ``tables`` and ``bits``. All
    ``1 << bits`` probes make the search exact. Rows and queries without a vector match nothing.
    """
    asked = queries.select(id_column(queries, query_id).alias("query_id"), F.col(vec).alias("vec"))
    rows = index.select(id_column(index, "id").alias("id"), F.col("embedding").alias("vec"), "codes")
    how = Scoring(k=k, exclude_self=exclude_self, query_type=to_arrow_type(asked.schema["query_id"].dataType),
                  id_type=to_arrow_type(rows.schema["id"].dataType))
    search = _send if fits_broadcast(asked, "8 * size(vec) + 64", send_limit) else _cells
    found = search(asked, rows, how, probes, tables, bits).drop("rank").dropDuplicates(["query_id", "id"])
    return top_k(found, k, ["query_id"], [F.desc("score"), F.asc("id")]).select("query_id", "id", "rank", "score")


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact results that the approximate list also holds, per query."""
    hit = approximate.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "id"], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"),
        F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))
