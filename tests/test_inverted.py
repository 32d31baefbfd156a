"""The stored inverted index against scoring every document, its skipping, batches and merging."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.embed import signature
from corpusflow.operators import inverted
from corpusflow.operators import sparse as S
from corpusflow.operators.inverted import LIGHT, TextIndex
from corpusflow.sources.manifest import active
from tables import SF

DOCS = "doc_id bigint, text string"


def corpus():
    """Common and rare words, one word in every document, copies, blank and missing texts."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(["the", *rng.choices(words, weights, k=rng.randint(3, 60))])) for i in range(400)]
    return [*rows, *[(1000 + i, rows[5][1]) for i in range(150)], (2000, None), (2001, ""), (2002, "the"), (2003, "the " * 50)]


ASKED = [(1, "the w1 w250"), (2, "w0 w0 w7 the"), (3, "nowhere"), (4, ""), (5, None), (6, "W3, w299; the!"), (7, "w298 w297 w296 w295"), (8, "the")]


def got(df):
    return sorted((r.query_id, r.id, r["rank"], r.score) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(4), spark.createDataFrame(ASKED, "query_id bigint, query string")


@pytest.fixture(scope="module")
def index(spark, tables, tmp_path_factory):
    index = TextIndex(spark, f"file://{tmp_path_factory.mktemp('index')}", buckets=8, segment=40)
    docs, _ = tables
    for name, part in (("a", "doc_id < 150"), ("b", "doc_id >= 150 AND doc_id < 1100"), ("c", "doc_id >= 1100")):
        assert index.append(name, docs.where(part))
    return index


@pytest.mark.parametrize("limit", [50_000, 0])
@pytest.mark.parametrize("k", [1, 6])
def test_equals_scoring_every_document(tables, index, k, limit):
    docs, queries = tables
    assert got(index.search(queries, k, send_limit=limit)) == got(S.bm25(queries, docs, k))


def test_statistics_add_up(tables, index):
    docs, _ = tables
    base = S.index_documents(docs)
    assert {tuple(r) for r in index.term_stats().collect()} == {tuple(r) for r in S.term_stats(base).collect()}
    assert index.totals() == tuple(S.corpus_stats(base).first())


def test_segments_that_cannot_win_are_not_read(tables, index, monkeypatch):
    """Queries with a rare word need few of the segments that hold their common words."""
    seen = {}
    real = TextIndex._by_segment
    monkeypatch.setattr(TextIndex, "_by_segment", lambda self, postings, live, *a: seen.update(live=live) or real(self, postings, live, *a))
    docs, _ = tables
    rare = index.term_stats().where("df <= 3").orderBy("term").first().term
    asked = docs.sparkSession.createDataFrame([(8, f"the {rare}")], "query_id bigint, query string")
    assert got(index.search(asked, 1)) == got(S.bm25(asked, docs, 1))
    every = index.postings().where("term = 'the'").count()
    assert 0 < seen["live"].count() <= 3 < every / 2


def test_reads_only_wanted_buckets_and_no_text(index):
    rows = index.bucketed([3])
    files = rows.select(F.input_file_name()).distinct().count()
    assert 0 < files < index.postings().select(F.input_file_name()).distinct().count() / 2
    light = rows.select(*LIGHT)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in light.split("PartitionFilters: [")[1].split("]")[0]
    read = light.split("ReadSchema")[1].split("\n")[0]
    assert "ids" not in read and "max_tf" in read


def test_batches_are_added_once_and_merged(spark, tables, tmp_path):
    docs, queries = tables
    index = TextIndex(spark, f"file://{tmp_path}/i", buckets=4, segment=64)
    parts = [docs.where(f"doc_id % 3 = {n}") for n in range(3)]
    for n, part in enumerate(parts):
        assert index.append(str(n), part) and not index.append(str(n), part)
    want = got(S.bm25(queries, docs, 5))
    assert got(index.search(queries, 5)) == want
    assert index.compact("merged") and index.batches() == [f"file://{tmp_path}/i/batch=merged"] and not index.compact("again")
    assert got(index.search(queries, 5)) == want
    assert index.append("late", spark.createDataFrame([(5000, "w299 " * 9)], DOCS))
    assert index.search(queries.where("query_id = 6"), 1).first().id == 5000


def test_a_batch_without_its_mark_does_not_count(spark, tables, tmp_path):
    docs, queries = tables
    index = TextIndex(spark, f"file://{tmp_path}/i")
    index.append("a", docs.where("doc_id < 100"))
    index.append("b", docs.where("doc_id >= 100"))
    (tmp_path / "i" / "batch=b" / "_COMMITTED").unlink()
    assert [f.rpartition("=")[2] for f in active(spark, index.folder)] == ["a"]
    assert got(index.search(queries, 3)) == got(S.bm25(queries, docs.where("doc_id < 100"), 3))
    assert index.append("b", docs.where("doc_id >= 100")) and got(index.search(queries, 3)) == got(S.bm25(queries, docs, 3))
    with pytest.raises(FileNotFoundError):
        TextIndex(spark, f"file://{tmp_path}/none").search(queries, 3)


def test_driver_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").selectExpr("item_id AS query_id", "text AS query")
    index = TextIndex(spark, f"file://{tmp_path}/i", segment=32)
    index.append("all", docs)
    assert got(index.search(queries, 4)) == got(S.bm25(queries, docs, 4))


def test_texts_are_dealt_before_they_are_cut_and_codes_are_signatures(spark, tables, tmp_path, monkeypatch):
    seen = {}
    real = inverted.stored
    monkeypatch.setattr(inverted, "stored", lambda df, name: seen.update({name: df}) or real(df, name))
    docs, _ = tables
    index = TextIndex(spark, f"file://{tmp_path}/i", segment=64)
    index.append("all", docs)
    plan = seen["documents-and-blocks"]._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("split(") < plan.index("RepartitionByExpression")
    want = docs.select("doc_id", signature("text").alias("codes"), F.coalesce(F.size(S.tokens("text")), F.lit(0)).alias("n"))
    assert sorted(map(str, index.docs().select("id", "codes", "n_terms").collect())) == sorted(
        str(r) for r in want.withColumnsRenamed({"doc_id": "id", "n": "n_terms"}).collect())


def test_merging_moves_full_blocks_and_joins_small_batches(spark, tables, tmp_path):
    docs, queries = tables
    index = TextIndex(spark, f"file://{tmp_path}/i", buckets=4, segment=64)
    for n, part in enumerate(("doc_id < 300", "doc_id >= 300 AND doc_id < 310", "doc_id >= 310 AND doc_id < 330", "doc_id < 0",
                              "doc_id >= 330 AND doc_id < 390", "doc_id >= 390 AND doc_id < 1040", "doc_id >= 1040")):
        index.append(str(n), docs.where(part))
    whole = index.postings().where("segment % 7 = 0").select("term", "ids", "tfs", "lens").collect()
    before = index.postings().select("segment").distinct().count()
    assert index.compact("merged")
    moved = {(r.term, tuple(r.ids), tuple(r.tfs), tuple(r.lens)) for r in index.postings().collect()}
    assert {(r.term, tuple(r.ids), tuple(r.tfs), tuple(r.lens)) for r in whole} <= moved
    assert index.postings().select("segment").distinct().count() == before - 1
    assert got(index.search(queries, 5)) == got(S.bm25(queries, docs, 5))
