import numpy as np
from pyspark.sql import functions as F

from corpusflow.operators import cache as C
from corpusflow.operators import sparse as S
from corpusflow.sources import stores
from corpusflow.streaming import jobs

T = 0.5


def requests(seed=5, n=240):
    """A hot tenant with half of the requests, exact copies and near copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, 6))
    rows = []
    for i in range(n):
        v = base[rng.integers(30)] + (0 if i % 3 == 0 else rng.normal(size=6) * 0.4)
        rows.append((0 if i % 2 else 1 + i % 5, i, [float(x) for x in np.float32(v)]))
    return rows


def sequential(rows, threshold, entries=()):
    """One request after the other."""
    held = [(t, i, np.array(v)) for t, i, v in entries]
    out = set()
    for t, i, v in sorted(rows, key=lambda r: r[1]):
        v = np.array(v)
        near = [(-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 6), j)
                for u, j, w in held if u == t]
        best = min(near, default=None)
        if best and -best[0] >= threshold:
            out.add((t, i, True, best[1], round(-best[0], 6)))
        else:
            out.add((t, i, False, None, None))
            held.append((t, i, v))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "tenant bigint, id bigint, embedding array<float>")


def got(df):
    return {(r.tenant, r.id, r.is_hit, r.cache_id, None if r.score is None else round(r.score, 6))
            for r in df.collect()}


def test_replay_equals_one_by_one(spark):
    rows = requests()
    expected = sequential(rows, T)
    assert 20 < sum(e[2] for e in expected) < 220
    assert got(C.replay(table(spark, rows), T)) == expected


def test_replay_on_top_of_stored_entries(spark):
    rows = requests()
    early, late = rows[:100], rows[100:]
    first = sequential(early, T)
    missed = {e[1] for e in first if not e[2]}
    entries = [r for r in early if r[1] in missed]
    assert got(C.replay(table(spark, late), T, stored=table(spark, entries))) == sequential(late, T, entries)


def test_stream_in_two_batches_equals_one_by_one(spark, tmp_path):
    rows = requests()
    folder = tmp_path / "in"
    for n, part in enumerate((rows[:90], rows[90:])):
        table(spark, part).coalesce(1).write.parquet(str(folder / f"part{n}"))
    source = (spark.readStream.schema(table(spark, []).schema).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", 1).parquet(str(folder)))
    done = jobs.replay_cache(source, str(tmp_path / "out"), T)
    assert got(done) == sequential(rows, T)


def test_stream_of_a_table_stored_as_one_file_or_as_a_folder(spark, tmp_path):
    rows = requests(n=60)
    table(spark, rows).repartition(3).write.parquet(str(tmp_path / "many" / "embeddings.parquet"))
    table(spark, rows).coalesce(1).write.parquet(str(tmp_path / "one" / "out"))
    next((tmp_path / "one" / "out").glob("part-*")).rename(tmp_path / "one" / "embeddings.parquet")
    for folder in ("many", "one"):
        source = jobs.file_stream(spark, str(tmp_path / folder), "embeddings.parquet")
        assert got(jobs.replay_cache(source, str(tmp_path / f"{folder}-out"), T)) == sequential(rows, T)


def test_ingest_of_a_table_stored_as_a_folder(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one red fox"), (2, "two foxes"), (3, "a red red hen"), (4, None)], "doc_id bigint, text string")
    docs.repartition(2).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    root = str(tmp_path / "out")
    jobs.ingest(jobs.file_stream(spark, str(tmp_path / "in"), "documents.parquet"), root)
    queries = spark.createDataFrame([(1, "red hen"), (2, "two")], "query_id bigint, query string")
    found = jobs.ingested_search(spark, root, queries, 2)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, S.bm25(queries, docs, 2).collect()))


def test_ingest_of_a_single_file_beside_a_partitioned_table(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one red fox"), (2, "two foxes"), (3, "a red red hen"), (4, None)], "doc_id bigint, text string")
    folder = tmp_path / "in"
    table(spark, requests(n=12)).write.partitionBy("tenant").parquet(str(folder / "embeddings.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*")).rename(folder / "documents.parquet")
    docs.coalesce(1).write.parquet(str(folder / "old" / "documents.parquet"))  # another table of the name, further down
    root = str(tmp_path / "out")
    jobs.ingest(jobs.file_stream(spark, str(folder), "documents.parquet"), root)
    assert spark.read.parquet(f"{root}/documents").count() == 4
    queries = spark.createDataFrame([(1, "red hen"), (2, "two")], "query_id bigint, query string")
    found = jobs.ingested_search(spark, root, queries, 2)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, S.bm25(queries, docs, 2).collect()))


def test_lookup_is_null_below_the_threshold_and_inclusive(spark):
    entries = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, embedding array<float>")
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.6, 0.8]), (9, [0.0, 1.0])],
                                  "query_id bigint, embedding array<float>")
    out = {r.query_id: r.cache_id for r in C.lookup(asked, entries, 0.6).collect()}
    assert out == {7: 1, 8: 1, 9: None}


def test_empty_answer_counts_as_a_miss(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "cached_response string")
    assert [r.response for r in C.answer(df).collect()] == [C.HIT_PREFIX + "x", None, None]


def test_embedding_cache_computes_each_text_once(spark, tmp_path):
    path = str(tmp_path / "vectors")
    docs = spark.createDataFrame([(1, "one text"), (2, "one text"), (3, "other")], "doc_id int, text string")
    a = stores.fill_cache(spark, docs.where("doc_id < 3"), path, "n")
    assert a.count() == 2 and stores.load(spark, path).count() == 1
    b = stores.fill_cache(spark, docs, path, "n")
    assert b.count() == 3 and stores.load(spark, path).count() == 2
    assert stores.cache_misses(docs, stores.load(spark, path), "other").count() == 2
    again = {r.doc_id: r.embedding for r in b.collect()}
    fresh = {r.id: r.embedding for r in stores.embed_table(docs).collect()}
    assert again == fresh and again[1] == again[2]


def test_store_overwrite_append_reload(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(10).withColumn("label", F.col("id") % 2)
    stores.save(rows, path)
    stores.save(rows, path)
    assert stores.load(spark, path).count() == 10
    stores.save(rows, path, "append")
    assert stores.load(spark, path).count() == 20
