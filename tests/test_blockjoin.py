import tracemalloc

import numpy as np
import pytest

from pyspark.sql import functions as F

from corpusflow.operators import retrieval as R
from corpusflow.plans import blockjoin
from corpusflow.plans.blockjoin import similar


def frame(spark, ids, matrix, name="id", extra=()):
    rows = [(int(i), [float(x) for x in v] if v is not None else None, *e)
            for i, v, e in zip(ids, matrix, extra or [()] * len(ids))]
    schema = f"{name} bigint, embedding array<float>" + (", tenant string" if extra else "")
    return spark.createDataFrame(rows, schema)


def brute(q_ids, q, ids, c, k, metric="dot", keep=lambda qi, i, s: True):
    q, c = np.float32(q).astype(float), np.float32(c).astype(float)
    out = []
    for qi, qv in zip(q_ids, q):
        scored = []
        for i, cv in zip(ids, c):
            if metric == "l2":
                s = -((qv - cv) ** 2).sum()
            elif metric == "cosine":
                s = qv @ cv / (np.linalg.norm(qv) * np.linalg.norm(cv))
            else:
                s = qv @ cv
            s = round(float(s), 6) + 0.0
            if keep(qi, i, s):
                scored.append((-s, i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.append((qi, i, rank, round(-s, 6) + 0.0))
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.id, r.rank, round(r.score, 6) + 0.0) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(300, 8)).round(2)
    corpus[50:150] = corpus[7]  # one vector is a third of the corpus
    return np.arange(300), corpus, np.arange(1000, 1040), rng.normal(size=(40, 8)).round(2)


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
@pytest.mark.parametrize("limit, small_corpus", [(8192, False), (1, False), (1, True)])
def test_every_plan_equals_brute_force(spark, data, metric, limit, small_corpus, monkeypatch):
    monkeypatch.setattr(blockjoin, "CORPUS_ROWS", 64)
    monkeypatch.setattr(blockjoin, "QUERY_ROWS", 16)
    ids, c, q_ids, q = data
    found = similar(frame(spark, q_ids, q, "query_id"), frame(spark, ids, c), 4, metric=metric,
                    send_limit=limit, small_corpus=small_corpus)
    assert got(found) == brute(q_ids, q, ids, c, 4, metric)


def test_small_tiles_keep_ties_in_id_order(spark, data, monkeypatch):
    ids, c, q_ids, q = data
    how = blockjoin.Scoring(k=5)
    monkeypatch.setattr(blockjoin, "TILE_CELLS", 400)
    found = []
    blocks = [(ids[::-1].astype(np.int64)[a:a + 90], np.float32(c[::-1]).astype(float)[a:a + 90])
              for a in range(0, 300, 90)]
    for batch in blockjoin._compare(how, q_ids.astype(np.int64), np.float32(q).astype(float), blocks):
        found += zip(*(col.to_pylist() for col in batch.columns[:3]))
    expected = {(a, b) for a, b, _, _ in brute(q_ids, q, ids, c, 5)}
    assert {(a, b) for a, b, _ in found} == expected


@pytest.mark.parametrize("rows_per_block", [16384, 40])
def test_groups_thresholds_order_and_nulls(spark, data, rows_per_block, monkeypatch):
    monkeypatch.setattr(blockjoin, "CORPUS_ROWS", rows_per_block)
    monkeypatch.setattr(blockjoin, "QUERY_ROWS", rows_per_block)
    ids, c, _, _ = data
    tenants = [("hot",) if i % 3 else (f"t{i % 5}",) for i in ids]
    rows = frame(spark, ids, [None if i == 5 else v for i, v in zip(ids, c)], "id", tenants)
    asked = rows.withColumnRenamed("id", "query_id")
    found = similar(asked, rows, 2, by=["tenant"], metric="cosine", min_score=0.2, earlier_only=True)
    tenant = {i: t for i, t in zip(ids, tenants)}
    keep = lambda q, i, s: 5 not in (q, i) and tenant[q] == tenant[i] and i < q and s >= 0.2
    assert got(found) == brute(ids, c, ids, c, 2, "cosine", keep)


def test_matrix_has_every_pair(spark, data):
    ids, c, q_ids, q = data
    rows = R.similarity_matrix(frame(spark, q_ids[:3], q[:3], "query_id"), frame(spark, ids, c)).collect()
    assert len(rows) == 3 * 300
    assert all(-1.000001 <= r.similarity <= 1.000001 for r in rows)


def test_mmr_first_pick_is_best_and_picks_differ(spark, data):
    ids, c, q_ids, q = data
    unit = c / np.linalg.norm(c, axis=1, keepdims=True)
    asked, rows = frame(spark, q_ids, q, "query_id"), frame(spark, ids, unit)
    best = {r.query_id: r.id for r in similar(asked, rows, 1).collect()}
    picks = R.nearest_diverse(asked, rows, 3, 5).collect()
    assert len(picks) == 3 * len(q_ids) == len({(r.query_id, r.id) for r in picks})
    assert {r.query_id: r.id for r in picks if r.rank == 1} == best


def test_struct_and_string_ids_in_the_grid(spark):
    rng = np.random.default_rng(3)
    rows = [(f"d{i % 7}", i, rng.normal(size=4).round(1).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "doc string, n int, embedding array<double>").withColumn("id", F.struct("doc", "n"))
    asked = df.withColumn("query_id", F.concat("doc", F.lit("-"), "n"))
    for limit in (100, 0):
        found = {}
        for r in similar(asked, df, 3, send_limit=limit).collect():
            found.setdefault(r.query_id, []).append((r["rank"], tuple(r.id)))
        for doc, n, v in rows:
            best = sorted(rows, key=lambda o: (-round(float(np.dot(v, o[2])), 6), o[0], o[1]))[:3]
            assert [x for _, x in sorted(found[f"{doc}-{n}"])] == [(d, m) for d, m, _ in best]


def test_ties_take_bounded_memory():
    how = blockjoin.Scoring(k=1)
    ids, rows = np.arange(4096), np.ones((4096, 4))
    tracemalloc.start()
    found = list(blockjoin._compare(how, ids, rows, [(ids, rows)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000 and found[0].column("id").to_pylist() == [0] * 4096


def test_blocks_grow_with_the_tables_up_to_what_a_task_holds(spark):
    for n, most in ((10_000, 8), (50_000, 16), (600_000, 40)):
        groups = spark.createDataFrame([(n, n, 64)], "_nq bigint, _nc bigint, _dim int")
        query_rows, corpus_rows = blockjoin._block_rows(groups, 384)
        assert -(-n // query_rows) + -(-n // corpus_rows) <= most and max(query_rows, corpus_rows) * 64 * 8 <= 16 << 20
