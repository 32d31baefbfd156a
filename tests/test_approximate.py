"""Approximate search: planes, probes, both plans against brute force, and recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import approximate as A
from corpusflow.operators import retrieval as R
from tables import SF


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    corpus = rng.normal(size=(400, 16)).round(2)
    corpus[100:230] = corpus[7]  # one vector, and so one code, is a third of the corpus
    queries = np.concatenate([corpus[:30], rng.normal(size=(20, 16)).round(2)])
    return corpus, queries


def frame(spark, name, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in zip(ids, matrix)],
                                 f"{name} bigint, embedding array<float>").repartition(3)


def brute(corpus, queries, k, probes, exclude_self):
    """Scores every pair and keeps those that share a looked-into code, one table at a time."""
    c, q = np.float32(corpus).astype(float), np.float32(queries).astype(float)
    signs = A.planes(c.shape[1])
    out = []
    for i, v in enumerate(q):
        near = set()
        for t in range(A.TABLES):
            plane = signs[t * A.BITS:(t + 1) * A.BITS]
            z = np.round(plane @ v, 6)
            cost = sorted((round(sum(z[b] ** 2 for b in range(A.BITS) if m >> b & 1), 6), m) for m in range(1 << A.BITS))
            side = lambda x: [bool(s >= 0) for s in np.round(plane @ x, 6)]
            own = side(v)
            looked = {tuple(s ^ bool(m >> b & 1) for b, s in enumerate(own)) for _, m in cost[:probes]}
            near |= {j for j, x in enumerate(c) if tuple(side(x)) in looked}
        scored = sorted((-round(float(v @ c[j]), 6), j) for j in near if not exclude_self or i != j)
        out += [(i, j, r, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_planes_are_orthogonal_signs():
    signs = A.planes(64)
    assert set(np.unique(signs)) == {-1.0, 1.0} and np.array_equal(signs @ signs.T, 64 * np.eye(48))


@pytest.mark.parametrize(("limit", "exclude_self", "probes"), [(8192, False, 4), (8192, True, 4), (0, False, 4), (0, True, 4), (8192, False, 256), (0, False, 256)])
def test_both_plans_equal_brute_force(spark, data, limit, exclude_self, probes):
    corpus, queries = data
    if limit == 0 and probes == 256:
        queries = queries[:6]
    index = A.index_vectors(frame(spark, "id", corpus))
    found = A.nearest_approximate(frame(spark, "query_id", queries), index, 4, probes, exclude_self=exclude_self, send_limit=limit)
    got = sorted((r.query_id, r.id, r["rank"], r.score) for r in found.collect())
    assert got == brute(corpus, queries, 4, probes, exclude_self)
    if probes == 256:
        exact = R.nearest(frame(spark, "query_id", queries), frame(spark, "id", corpus), 4)
        assert got == sorted((r.query_id, r.id, r["rank"], r.score) for r in exact.collect())


def test_missing_vectors_and_empty_sides_match_nothing(spark, data):
    corpus, _ = data
    rows = frame(spark, "id", [*corpus[:20], None], [*range(20), 99])
    asked = frame(spark, "query_id", [corpus[3], None], [1, 2])
    for limit in (10, 0):
        got = A.nearest_approximate(asked, A.index_vectors(rows), 2, send_limit=limit).collect()
        assert {r.query_id for r in got} == {1} and got and 99 not in {r.id for r in got}
        assert A.nearest_approximate(asked.where("query_id > 5"), A.index_vectors(rows), 2, send_limit=limit).collect() == []
        assert A.nearest_approximate(asked, A.index_vectors(rows.limit(0)), 2, send_limit=limit).collect() == []


def test_string_ids(spark, data):
    corpus, _ = data
    rows = frame(spark, "id", corpus[:40]).withColumn("id", F.format_string("v%03d", "id"))
    asked = rows.withColumnRenamed("id", "query_id")
    found = [sorted(map(str, A.nearest_approximate(asked, A.index_vectors(rows), 2, send_limit=n).collect())) for n in (100, 0)]
    assert found[0] == found[1] and len(found[0]) == 80


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_recall_on_vectors_without_structure(spark, sf):
    """These vectors point in random directions, the hardest case for any index."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    asked = rows.withColumnRenamed("id", "query_id")
    told = A.recall(A.nearest_approximate(asked, A.index_vectors(rows), 5, exclude_self=True), R.nearest(asked, rows, 5, exclude_self=True))
    assert told.agg(F.avg("recall")).first()[0] >= 0.9


def test_recall_with_few_probes_on_clustered_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 64))
    points = (centres[rng.integers(0, 40, 1200)] + 0.3 * rng.normal(size=(1200, 64)))
    rows = frame(spark, "id", points)
    asked = rows.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    exact = R.nearest(asked, rows, 5, exclude_self=True)
    told = A.recall(A.nearest_approximate(asked, A.index_vectors(rows), 5, probes=4, exclude_self=True), exact)
    assert told.agg(F.avg("recall")).first()[0] >= 0.9
