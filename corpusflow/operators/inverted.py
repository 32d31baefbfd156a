"""A stored inverted index: built once, appended to in batches, searched without reading a text.

Documents are dealt by a hash of their id into segments of about ``SEGMENT`` documents. The
postings of a term inside one segment are one row (a block) with the largest term count, the least
length and one good posting beside it, so no row is long, however frequent a term is. Blocks are
stored in buckets of the term's hash, sorted by term.

A search reads the light columns of the wanted terms first. They give document frequencies, a
score that ``k`` documents surely reach (the k-th best of a term's good postings) and the most that
any document of a segment can reach. Postings are then read for the segments that can still win
(block-max skipping, Ding & Suel 2011) and brought together by segment, as arrays; a task adds up a
segment's scores and returns its best ``k`` per query. Large query tables meet the same blocks on
(term, segment) as rows.

A batch counts once its mark stands, which is written last. Merging writes a batch that names
those it replaces, from the stored postings alone.
"""

from __future__ import annotations

from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embed import DIM, list_parts
from ..functions.text import text_key, tokens
from ..plans.blockjoin import SCHEMA, TILE_CELLS, BestRows, Scoring
from ..plans.ranking import top_k
from ..plans.sizing import fits_broadcast, in_groups, stored
from ..sources.manifest import active, set_mark
from .sparse import B, K1, MAX_QUERIES_SENT, MAX_QUERY_CHARS_SENT, _idf, _saturation, query_terms

SEGMENT = 1024  # documents
TASK = 16       # segments that one task packs
BUCKETS = 64
LIGHT = ["bucket", "term", "segment", "n", "max_tf", "min_len", "good_tf", "good_len"]
BLOCK = ("term string, segment bigint, n int, max_tf int, min_len int, good_tf int, good_len int, "
         "ids array<bigint>, tfs array<int>, lens array<int>")
DOCS = "id bigint, text_key string, codes array<int>, n_terms int"
BOTH = f"{DOCS}, {BLOCK}"
_INT, _LONG = pa.int32(), pa.int64()
BOTH_ARROW = pa.schema([
    ("id", _LONG), ("text_key", pa.string()), ("codes", pa.list_(_INT)), ("n_terms", _INT), ("term", pa.string()), ("segment", _LONG),
    *[(c, _INT) for c in ("n", "max_tf", "min_len", "good_tf", "good_len")], ("ids", pa.list_(_LONG)), ("tfs", pa.list_(_INT)), ("lens", pa.list_(_INT))])
TOKENS = 1 << 19  # handled at once in a task


def bucket_of(term: str, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _packed(segment: int, terms: pa.Array, code: np.ndarray, id: np.ndarray, tf: np.ndarray, length: np.ndarray) -> pa.Table:
    """The postings of one segment as one row per term, by document; ``code`` numbers the terms."""
    order = np.lexsort((id, code))
    code, id, tf, length = code[order], id[order], tf[order], length[order]
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    # Any posting gives a score that is surely reached; this one is good at any usual mean length.
    value = _saturation(tf.astype(float), length, max(length.mean(), 1.0)) if len(length) else tf
    good = np.lexsort((value, code))[np.append(starts[1:], len(code))[:len(starts)] - 1]
    ends = pa.array(np.append(starts, len(code)).astype(np.int32))
    smallest = lambda x, f: f.reduceat(x, starts).astype(np.int32) if len(starts) else np.zeros(0, np.int32)
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (id.astype(np.int64), tf.astype(np.int32), length.astype(np.int32))]
    return pa.Table.from_arrays(
        [terms.take(pa.array(code[starts])), pa.array(np.full(len(starts), segment, np.int64)),
         pa.array(np.diff(np.append(starts, len(code))).astype(np.int32)), pa.array(smallest(tf, np.maximum)),
         pa.array(smallest(length, np.minimum)), pa.array(tf[good].astype(np.int32)), pa.array(length[good].astype(np.int32)), *lists],
        [c.split()[0] for c in BLOCK.split(", ")])


def _signed(terms: pa.Array, dim: int) -> np.ndarray:
    """The number that ``signature`` gives each term."""
    digests = b"".join(md5(t).digest()[:4] for t in terms.cast(pa.binary()).to_pylist())
    head = np.frombuffer(digests, ">u4").astype(np.int64)
    return ((head >> 4) % dim + 1) * np.where(head & 15 < 8, 1, -1)


def _doc_rows(batch: pa.RecordBatch, terms: pa.DictionaryArray, size: np.ndarray, dim: int) -> pa.RecordBatch:
    """Rows of ``DOCS`` from ``(segment, id, text_key, terms)``."""
    signs = _signed(terms.dictionary, dim).astype(np.int32)
    ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    missing = batch.column("terms").is_null()
    codes = pa.ListArray.from_arrays(ends, pa.array(signs[np.asarray(terms.indices)]), mask=missing)
    columns = [batch.column("id"), batch.column("text_key"), codes, pa.array(size.astype(np.int32))]
    return _filled(columns, [c.split()[0] for c in DOCS.split(", ")], batch.num_rows)


def _filled(columns: list[pa.Array], names: list[str], rows: int) -> pa.RecordBatch:
    """A batch of ``BOTH`` in which the columns that are not given are null."""
    given = dict(zip(names, columns, strict=True))
    return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(rows, f.type) for f in BOTH_ARROW], schema=BOTH_ARROW)


def _from_tokens(segment: int, ids: list[np.ndarray], parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.Table:
    """Blocks of one segment; each part has its terms, the place of each token in them and the documents' sizes."""
    terms = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    base = np.cumsum([0, *[len(p[0]) for p in parts]])
    place = np.concatenate([np.asarray(terms.indices)[b + p[1]] for b, p in zip(base, parts)]).astype(np.int64)
    id, size = np.concatenate(ids), np.concatenate([p[2] for p in parts])
    width = max(len(terms.dictionary), 1)
    pair, tf = np.unique(np.repeat(np.arange(len(size)), size) * width + place, return_counts=True)
    doc = pair // width
    return _packed(segment, terms.dictionary, pair % width, id[doc], tf, size[doc])


def _indexer(dim: int):
    """Arrow function over rows ``(segment, id, text_key, terms)`` in order of their segments: documents and blocks."""
    def task(batches):
        held, ids, parts = None, [], []

        def packed():
            rows = _from_tokens(held, ids, parts)
            return [_filled(b.columns, b.schema.names, b.num_rows) for b in rows.combine_chunks().to_batches()]

        for batch in batches:
            # A long text weighs as much as many short ones, so tokens bound what is handled at once.
            lengths = batch.column("terms").value_lengths().fill_null(0).to_pylist()
            for a, b in in_groups(lengths, TOKENS):
                part = batch.slice(a, b - a)
                size = np.array(lengths[a:b], np.int64)
                terms = part.column("terms").flatten().dictionary_encode()
                yield _doc_rows(part, terms, size, dim)
                segment, at = part.column("segment").to_numpy(), np.concatenate([[0], np.cumsum(size)])
                cuts = np.flatnonzero(np.diff(segment, prepend=segment[0] - 1))
                for lo, hi in zip(cuts, [*cuts[1:], len(segment)]):
                    if held is not None and segment[lo] != held:
                        yield from packed()
                        ids, parts = [], []
                    held = int(segment[lo])
                    mine = np.asarray(terms.indices)[at[lo]:at[hi]]
                    used, place = np.unique(mine, return_inverse=True)
                    ids.append(part.column("id").to_numpy(zero_copy_only=False)[lo:hi])
                    parts.append((terms.dictionary.take(pa.array(used)), place, size[lo:hi]))
        if held is not None:
            yield from packed()

    return task


def _from_postings(rows: pa.Table) -> pa.Table:
    """Blocks of one segment from ``(segment, term, id, tf, length)``."""
    terms = rows.column("term").combine_chunks().dictionary_encode()
    return _packed(rows.column("segment")[0].as_py(), terms.dictionary, np.asarray(terms.indices), *(rows.column(c).to_numpy() for c in ("id", "tf", "length")))


class TextIndex:
    """Postings and document rows of a corpus in a folder; ids are integers, each in one batch only."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, segment: int = SEGMENT):
        self.spark, self.folder, self.buckets, self.segment = spark, folder.rstrip("/"), buckets, segment
        self._known: tuple = (None, (0, 0))

    def batches(self) -> list[str]:
        return active(self.spark, self.folder)

    def _segments(self, rows: int):
        return F.pmod(F.xxhash64("id"), F.lit(max(1, -(-rows // self.segment)))).cast("bigint")

    def _write(self, folder: str, docs: DataFrame, blocks: DataFrame) -> None:
        docs.write.mode("overwrite").parquet(f"{folder}/docs")
        blocks = blocks.withColumn("bucket", bucket_of("term", self.buckets))
        blocks = blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "segment")
        blocks.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")

    def append(self, name: str, docs: DataFrame, id: str = "doc_id", text: str = "text", dim: int = DIM) -> bool:
        """Add a batch of new documents; tells whether the batch was new. A null text has no terms.

        The documents of a segment come together in one task, which cuts each text once and packs the blocks.
        """
        folder = f"{self.folder}/batch={name}"
        if folder in self.batches():
            return False
        n = docs.count()
        # Texts are dealt by segment before they are cut into terms, which are several times as large.
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-n // (TASK * self.segment)))
        dealt = (docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).withColumn("segment", self._segments(n))
                 .repartition(tasks, "segment").sortWithinPartitions("segment"))
        rows = dealt.select("segment", "id", text_key("text").alias("text_key"), tokens("text").alias("terms"))
        both = stored(rows.mapInArrow(_indexer(dim), BOTH), "documents-and-blocks")
        names = lambda schema: [c.split()[0] for c in schema.split(", ")]
        self._write(folder, both.where("term IS NULL").select(*names(DOCS)), both.where("term IS NOT NULL").select(*names(BLOCK)))
        set_mark(self.spark, folder)
        return True

    def compact(self, name: str) -> bool:
        """Merge all batches into one, from their postings; tells whether there was anything to merge.

        Blocks are moved as they are; only those of batches below half a segment are packed anew.
        """
        old = self.batches()
        if len(old) < 2:
            return False
        docs = stored(self.docs().groupBy("batch_no").agg(F.count(F.lit(1)).alias("n")), "sizes")
        sizes = dict(docs.collect())
        # Segments of their usual size only get new numbers. Batches too small for one are put together.
        first, joined, at, room = {}, [], 0, 0
        for n in range(len(old)):
            size = sizes.get(n, 0)
            if size >= self.segment // 2:
                first[n], at = at, at + -(-size // self.segment)
                continue
            if size > room:
                joined_at, at, room = at, at + 1, self.segment
            first[n], room = joined_at if size else 0, room - size
            joined.append(n)
        shift = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for pair in first.items() for x in pair]), F.col("batch_no").cast("bigint"))
        rows = self._read("postings", f"{BLOCK}, bucket int").withColumn("segment", F.col("segment") + shift)
        blocks = rows.where(~F.col("batch_no").isin(joined)).select(*[c.split()[0] for c in BLOCK.split(", ")])
        if joined:
            each = F.explode(F.arrays_zip("ids", "tfs", "lens")).alias("p")
            few = rows.where(F.col("batch_no").isin(joined)).select("segment", "term", each).select(
                "segment", "term", F.col("p.ids").alias("id"), F.col("p.tfs").alias("tf"), F.col("p.lens").alias("length"))
            blocks = blocks.unionByName(few.groupBy("segment").applyInArrow(_from_postings, BLOCK))
        folder = f"{self.folder}/batch={name}"
        self._write(folder, self.docs().drop("batch_no"), blocks)
        set_mark(self.spark, folder, replaces=old)
        return True

    def _read(self, table: str, schema: str) -> DataFrame:
        parts = [self.spark.read.schema(schema).parquet(f"{f}/{table}").withColumn("batch_no", F.lit(n)) for n, f in enumerate(self.batches())]
        if not parts:
            raise FileNotFoundError(f"no batch in {self.folder}")
        return reduce(DataFrame.unionByName, parts)

    def docs(self) -> DataFrame:
        """``(id, text_key, codes, n_terms, batch_no)`` of every document."""
        return self._read("docs", DOCS)

    def postings(self) -> DataFrame:
        """Blocks; segments of different batches have different numbers."""
        rows = self._read("postings", f"{BLOCK}, bucket int")
        return rows.withColumn("segment", F.col("segment") * F.lit(len(self.batches())) + F.col("batch_no")).drop("batch_no")

    def totals(self) -> tuple[int, int]:
        """Documents and terms of the present batches."""
        state = tuple(self.batches())
        if state != self._known[0]:
            self._known = state, tuple(self.docs().agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first())
        return self._known[1]

    def term_stats(self) -> DataFrame:
        """``(term, df)``, from the blocks' sizes."""
        return self.postings().groupBy("term").agg(F.sum("n").alias("df"))

    def search(self, queries: DataFrame, k: int, query_id: str = "query_id", query: str = "query",
               send_limit: int = MAX_QUERIES_SENT) -> DataFrame:
        """BM25 top-k per query, equal to scoring every document."""
        n_docs, sum_terms = self.totals()
        avg_terms = float(sum_terms or 1) / max(n_docs, 1)
        # A query has fewer distinct terms than characters, so its text bounds the rows to send.
        small = fits_broadcast(queries, f"length(`{query}`)", send_limit, MAX_QUERY_CHARS_SENT)
        wanted = query_terms(queries, query_id, query).select(
            F.col("query_id").cast("bigint").alias("query_id"), bucket_of("term", self.buckets).alias("bucket"), "term", "qtf")
        got = wanted.toArrow() if small else None
        wanted = self.spark.createDataFrame(got) if small else stored(wanted, "wanted")
        hinted = F.broadcast if small else lambda df: df
        buckets = got.column("bucket").unique() if small else wanted.select("bucket").distinct().toArrow().column("bucket")
        postings = self.bucketed(buckets.to_pylist())
        light = stored(postings.select(*LIGHT).join(hinted(wanted.select("bucket", "term").distinct()), ["bucket", "term"]), "light")
        weighted = light.groupBy("bucket", "term").agg(F.sum("n").alias("df")).join(hinted(wanted), ["bucket", "term"]).select(
            "query_id", "bucket", "term", (F.col("qtf") * _idf(F.col("df"), F.lit(float(n_docs)))).alias("weight"))
        sent = weighted.toArrow() if small else None
        weighted = self.spark.createDataFrame(sent) if small else stored(weighted, "weighted")
        live = stored(self._live(light, weighted, k, avg_terms, hinted), "live")
        if small:
            scored = self._by_segment(postings, live, sent, k, avg_terms)
        else:
            scored = self._by_rows(postings, live, avg_terms)
        ranked = top_k(scored, k, ["query_id"], [F.desc("score"), F.asc("id")])
        return ranked.select("query_id", "id", "rank", "score")

    def bucketed(self, buckets: list[int]) -> DataFrame:
        """Postings of some buckets; the folders of others are not read."""
        return self.postings().where(F.col("bucket").isin(buckets))

    def _live(self, light: DataFrame, weighted: DataFrame, k: int, avg_terms: float, hinted) -> DataFrame:
        """``(query_id, segment, terms[(bucket, term, weight)])`` of the segments that can hold a top-k document."""
        most = _saturation(F.col("max_tf").cast("double"), F.col("min_len"), avg_terms)
        good = _saturation(F.col("good_tf").cast("double"), F.col("good_len"), avg_terms)
        met = light.join(hinted(weighted), ["bucket", "term"]).select(
            "query_id", "bucket", "term", "segment", "weight", (F.col("weight") * most).alias("most"), (F.col("weight") * good).alias("good"))
        # A term's good postings are in different documents, so k documents reach the k-th of them.
        reached = top_k(met, k, ["query_id", "term"], [F.desc("good")], "place").where(F.col("place") == k)
        reached = reached.groupBy("query_id").agg(F.max("good").alias("reached"))
        each = met.groupBy("query_id", "segment").agg(
            F.sum("most").alias("most"), F.collect_list(F.struct("bucket", "term", "weight")).alias("terms"))
        # The margin keeps documents whose rounded score ties.
        return each.join(hinted(reached), "query_id", "left").where(
            F.col("reached").isNull() | (F.col("most") >= F.col("reached") - 2e-6)).select("query_id", "segment", "terms")

    def _by_segment(self, postings: DataFrame, live: DataFrame, weighted: pa.Table, k: int, avg_terms: float) -> DataFrame:
        """Best ``k`` documents of each segment and query."""
        weights: dict[str, tuple[list[int], list[float]]] = {}
        for q, term, weight in zip(*(weighted.column(c).to_pylist() for c in ("query_id", "term", "weight")), strict=True):
            found = weights.setdefault(term, ([], []))
            found[0].append(q)
            found[1].append(weight)
        sent = self.spark.sparkContext.broadcast({t: (np.array(q, np.int64), np.array(w)) for t, (q, w) in weights.items()})

        def score(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
            if not blocks.num_rows:
                return pa.Table.from_batches([BestRows(0, k).rows(Scoring(k=k), np.zeros(0, np.int64))])
            asked = np.unique(wanted.column("query_id").to_numpy())
            flat, starts = list_parts(blocks.column("ids"))
            ids, place = np.unique(flat, return_inverse=True)
            tf, length = list_parts(blocks.column("tfs"))[0], list_parts(blocks.column("lens"))[0]
            part = _saturation(tf.astype(float), length, avg_terms)
            step, found = max(TILE_CELLS // len(ids), 1), []
            for at in range(0, len(asked), step):
                mine = asked[at:at + step]
                scores = np.zeros((len(mine), len(ids)))
                for b, term in enumerate(blocks.column("term").to_pylist()):
                    who, weight = sent.value[term]
                    row = np.searchsorted(mine, who)
                    ok = (row < len(mine)) & (mine[np.minimum(row, len(mine) - 1)] == who)
                    span = slice(starts[b], starts[b + 1])
                    scores[np.ix_(row[ok], place[span])] += weight[ok][:, None] * part[span][None, :]
                scores = np.round(scores, 6)
                scores[scores <= 0.0] = -np.inf
                best = BestRows(len(mine), k)
                best.add(scores, ids)
                found.append(best.rows(Scoring(k=k), mine))
            return pa.Table.from_batches(found)

        asked = live.select("segment", "query_id")
        needed = live.select("segment", F.explode("terms").alias("t")).select("segment", "t.bucket", "t.term").distinct()
        small = F.broadcast(needed) if fits_broadcast(needed, "64 + length(term)") else needed
        blocks = postings.select("bucket", "term", "segment", "ids", "tfs", "lens").join(small, ["bucket", "term", "segment"])
        return (blocks.select("segment", "term", "ids", "tfs", "lens").groupBy("segment")
                .cogroup(asked.groupBy("segment")).applyInArrow(score, SCHEMA).drop("rank"))

    def _by_rows(self, postings: DataFrame, live: DataFrame, avg_terms: float) -> DataFrame:
        """All scores, for more queries than can be sent: blocks meet their queries on (term, segment)."""
        asked = live.select("query_id", "segment", F.explode("terms").alias("t")).select("query_id", "segment", "t.*")
        met = postings.join(asked, ["bucket", "term", "segment"])
        rows = met.select("query_id", "weight", F.explode(F.arrays_zip("ids", "tfs", "lens")).alias("p"))
        part = F.col("weight") * _saturation(F.col("p.tfs").cast("double"), F.col("p.lens"), avg_terms)
        return rows.groupBy("query_id", F.col("p.ids").alias("id")).agg(F.round(F.sum(part), 6).alias("score")).where("score > 0")
