"""Embeddings, vector expressions, and the shape of the plans that matter at scale."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tables import SF
from corpusflow.functions import embed as E
from corpusflow.functions import vector as V
from corpusflow.operators import sparse as S
from corpusflow.plans import sizing
from corpusflow.queries import QUERIES
from corpusflow.sources import stores


def hashed(text, dim=E.DIM):
    v = np.zeros(dim)
    for token in text.lower().split():
        h = hashlib.md5(token.encode()).hexdigest()
        v[int(h[:7], 16) % dim] += 1 if h[7] < "8" else -1
    return v / (np.linalg.norm(v) or 1.0)


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).first().v


def test_embedding_equals_its_definition(spark):
    for text in ("alpha beta beta gamma", "x", ""):
        assert np.allclose(one(spark, text, E.embed("t")), hashed(text), atol=1e-7)
    assert len(one(spark, "alpha", E.embed("t", 32))) == 32


def test_query_prompt_goes_in_front(spark):
    assert np.allclose(one(spark, "beta", E.embed("t", prompt="alpha ")), hashed("alpha beta"), atol=1e-7)


def test_tiles_do_not_change_sentence_results(spark, monkeypatch):
    sentences = [["a b", "a b c", "x y", "x z", "q"], ["one"], [], ["a", "a", "b", "b", "c", "c"]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sentences)], "id int, s array<string>")
    coded = df.select("id", F.transform("s", lambda t: E.signature(t)).alias("c")).coalesce(1)
    whole = sorted((r.id, r.v) for r in coded.select("id", E.semantic_starts()("c").alias("v")).collect())
    assert whole[1][1] == [0] and whole[2][1] == []
    monkeypatch.setattr(E, "TILE", 2)
    codes = [np.array([b for b in row], dtype=object) for row in coded.orderBy("id").toPandas()["c"]]
    flat = [np.asarray(s, np.int32) for row in codes for s in row]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in flat])]).astype(np.int64)
    values = np.concatenate(flat)
    dense = E.expand(values, starts, E.DIM)
    seen = {}
    for first, end, part in E._tiles(starts, values, E.DIM, overlap=1):
        assert end - first <= 3
        for n, row in enumerate(part, first):
            seen[n] = row
    assert all(np.array_equal(seen[n], dense[n]) for n in range(len(flat)))


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    row = df.select(V.dot("a", "b"), V.norm("a"), V.cosine("a", "b"), V.squared_l2("a", "b"), V.dimension("a"),
                    V.head("a", 1), V.all_close("a", "b"), V.all_close("a", "a"),
                    V.distance_similarity(V.squared_l2("a", "b"))).first()
    assert list(row) == [24.0, 5.0, 0.96, 2.0, 2, [3.0], False, True, 1 / 3]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metadata_filter_reaches_the_scan(spark):
    text = plan(QUERIES["knn_filtered"](spark, SF))
    assert "EqualTo(label,3)" in text[text.index("PushedFilters"):]


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["token_estimate"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


@pytest.mark.parametrize("name", ["recursive_chunk", "semantic_chunk", "smart_chunk", "header_chunk"])
def test_chunking_has_no_shuffle_but_the_rebalance_of_a_single_file(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("Exchange") == text.count("REPARTITION_BY_NUM") == 1


def test_many_files_are_read_in_place(spark, tmp_path):
    spark.range(100).repartition(12).write.parquet(str(tmp_path / "many"))
    assert "Exchange" not in plan(sizing.spread(spark.read.parquet(str(tmp_path / "many")), "id"))


def test_bm25_shuffles_no_tokens(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.repartition(10).write.parquet(str(tmp_path / "docs"))
    queries = spark.createDataFrame([(1, "the of")], "query_id bigint, query string")
    found = S.bm25(queries, spark.read.parquet(str(tmp_path / "docs")), 3)
    above, below = plan(found).split("MapInArrow")
    assert above.count("Exchange") == above.count("Exchange hashpartitioning(query_id") == 1
    assert "Exchange" not in below


def test_size_checks(spark):
    assert sizing.fits_broadcast(spark.range(10))
    assert not sizing.fits_broadcast(spark.range(11), max_rows=10)
    assert not sizing.fits_broadcast(spark.range(10), "100", max_bytes=999)
    assert sizing.fits_broadcast(spark.range(0))


def test_materialised_rows_have_no_lineage(spark):
    df = sizing.materialise(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in plan(df) and df.count() == 5


def test_rebalanced_store_splits_nothing_away(spark, tmp_path):
    rows = spark.range(3000).withColumn("cell", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7))
    stores.save(rows, str(tmp_path / "s"), partition_by=["cell"])
    back = stores.load(spark, str(tmp_path / "s"))
    assert back.count() == 3000 and back.where("cell = 0").count() == rows.where("cell = 0").count()
    assert "PartitionFilters: [isnotnull(cell" in plan(back.where("cell = 0"))
