import math

from pyspark.sql import functions as F

from corpusflow.functions.text import text_key
from corpusflow.operators import fusion as U
from corpusflow.operators import sparse as S

DOCS = ["Router manual: open the admin panel and set the router password.",
        "The router router router restarts after an update.",
        "Images need alt text; contrast must be sufficient.",
        "Refused connections: check the firewall of the target server.", "...", None]


def corpus(spark, docs=DOCS):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")


def asked(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query string")


def words(text):
    return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]


def brute(queries, docs, k):
    terms = [words(d) for d in docs]
    avg = sum(map(len, terms)) / len(docs)
    out = []
    for q, text in enumerate(queries):
        scored = []
        for i, doc in enumerate(terms):
            s = 0.0
            for t in words(text):
                df = sum(t in d for d in terms)
                tf = doc.count(t)
                if tf:
                    s += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * 2.5 / (
                        tf + 1.5 * (0.25 + 0.75 * len(doc) / avg))
            if s > 0:
                scored.append((-round(s, 6), i))
        out += [(q, i, n, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def rows(df):
    return sorted((r.query_id, r.id, r["rank"], round(r.score, 6)) for r in df.collect())


def test_bm25_in_both_plans_equals_brute_force(spark):
    queries = ["router router password", "the firewall", "absent words only", "?!"]
    docs = [d or "" for d in DOCS]
    for limit in (1000, 0):
        found = S.bm25(asked(spark, queries), corpus(spark, docs), 3, send_limit=limit)
        assert rows(found) == sorted(brute(queries, docs, 3))


def test_hot_copies_and_salted_plan_agree(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_CELLS", 50)
    docs = ["the same words again"] * 200 + [f"word{i} again" for i in range(100)]
    queries = ["the same again word5", "again"]
    a = S.bm25(asked(spark, queries), corpus(spark, docs), 5)
    b = S.bm25(asked(spark, queries), corpus(spark, docs), 5, send_limit=0)
    assert rows(a) == rows(b) == sorted(brute(queries, docs, 5))


def test_statistics_add_up_over_batches(spark):
    df = corpus(spark)
    parts = [S.index_documents(df.where(F.col("doc_id") % 2 == n)) for n in (0, 1)]
    merged = S.merge_stats(*[S.term_stats(p) for p in parts])
    whole = S.term_stats(S.index_documents(df))
    assert set(map(tuple, merged.collect())) == set(map(tuple, whole.collect()))


def ranked(spark, items):
    return spark.createDataFrame(
        [(0, i, n, 0.0) for n, i in enumerate(items, 1)], "query_id bigint, id bigint, rank int, score double")


def test_fusion_formula_merges_equal_texts(spark):
    docs = corpus(spark, ["x", "y", "x", "z"])
    out = U.fuse([ranked(spark, [0, 1]), ranked(spark, [2, 3, 1])], [0.4, 0.6], docs, 3).collect()
    scores = {r.id: r.score for r in out}
    assert scores == {0: round(0.4 / 60 + 0.6 / 60, 9), 1: round(0.4 / 61 + 0.6 / 62, 9),
                      3: round(0.6 / 61, 9)}
    assert [r.id for r in sorted(out, key=lambda r: r["rank"])] == [0, 1, 3]


def test_ranks_from_one(spark):
    out = U.fuse([ranked(spark, [1])], [0.4], corpus(spark), None, first_rank=1).collect()
    assert out[0].score == round(0.4 / 61, 9)


def test_hybrid_finds_the_exact_term_and_small_flag_changes_nothing(spark):
    docs, q = corpus(spark), asked(spark, ["router password", "firewall server"])
    found = U.hybrid_search(q, docs, 2)
    first = {r.query_id: r.id for r in found.collect() if r["rank"] == 1}
    assert first == {0: 0, 1: 3}
    legs = [S.bm25(q, docs, 2), U.dense_text_search(q, docs, 2)]
    assert rows(U.fuse(legs, [0.5, 0.5], docs, 2, small=True)) == rows(U.fuse(legs, [0.5, 0.5], docs, 2))


def test_identity_is_the_text(spark):
    keys = corpus(spark, ["a", "a", "b"]).select(text_key("text").alias("k")).collect()
    assert len({r.k for r in keys}) == 2
