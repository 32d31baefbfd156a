import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tables import SF
from corpusflow.operators import chunking as K
from corpusflow.operators import retrieval as R
from corpusflow.queries import QUERIES

TEXTS = st.text(alphabet="ab \n", max_size=300)


def slow_pack(text, size, overlap, separators):
    """Recursive splitting stated again, one piece at a time and with characters as pieces."""
    separator = next((s for s in separators if s in text), separators[-1])
    finer = separators[separators.index(separator) + 1:]
    if separator == "":
        pieces = list(text)
    else:
        pieces, at = [], 0
        while True:
            cut = text.find(separator, at + len(separator) if pieces or text.startswith(separator) else at)
            if cut < 0:
                pieces.append(text[at:])
                break
            pieces.append(text[at:cut])
            at = cut
        pieces = [p for p in pieces if p]
    chunks, held = [], []

    def flush():
        if held:
            chunks.append("".join(held))

    for piece in pieces:
        if len(piece) > size and finer:
            flush()
            held.clear()
            chunks += slow_pack(piece, size, overlap, finer)
            continue
        if held and len("".join(held)) + len(piece) > size:
            flush()
            while held and (len("".join(held)) > overlap or len("".join(held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    flush()
    return [c.strip() for c in chunks if c.strip()]


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(3, 40), st.integers(0, 2))
def test_split_equals_brute_force(text, size, overlap):
    assert K.split_text(text, size, overlap) == slow_pack(text, size, overlap, K.PLAIN)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(3, 40))
def test_chunks_fit_and_cover_the_text(text, size):
    chunks = K.split_text(text, size, 0)
    assert all(len(c) <= size for c in chunks)
    assert "".join("".join(chunks).split()) == "".join(text.split())


def test_overlap_repeats_the_end_of_the_chunk_before():
    text = "one two three four five six seven eight nine ten"
    plain, lapped = K.split_text(text, 20, 0), K.split_text(text, 20, 8)
    assert plain == ["one two three four", "five six seven", "eight nine ten"]
    # The blank in front of a word belongs to the word, so " seven eight nine ten" would be 21 long.
    assert lapped == ["one two three four", "four five six seven", "seven eight nine", "nine ten"]


def test_code_is_cut_at_definitions():
    code = ("import os\n\n\ndef first(a):\n    return a + 1\n\n\nclass Box:\n    def __init__(self):\n"
            "        self.a = 1\n\n\ndef last(b):\n    return b * 2\n")
    chunks = K.split_text(code, 60, 0, K.PYTHON)
    assert chunks[0].startswith("import os")
    assert any(c.startswith("class Box") for c in chunks) and any(c.startswith("def last") for c in chunks)
    assert all(len(c) <= 60 for c in chunks)


def test_driver_documents_split_as_brute_force_says(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {}
    for r in QUERIES["recursive_chunk"](spark, SF).collect():
        found.setdefault(r.doc_id, []).append((r.chunk_no, r.chunk))
    short = [i for i, t in docs.items() if len(t) < 6000]
    assert len(short) > 100
    for i in short:
        assert [c for _, c in sorted(found.get(i, []))] == slow_pack(docs[i], 300, 30, K.PLAIN)


def test_headers_nest_reset_and_skip_code(spark):
    text = ("intro\n# A\ntext a\n## B\ntext b\n### C\ntext c\n## D\ntext d\n```\n# not a header\n```\n"
            "# E\n\n# F\n#### deep\ntext f")
    rows = K.header_chunks(spark.createDataFrame([(1, text)], "id int, text string")).collect()
    assert [(r.chunk_no, r.h1, r.h2, r.h3, r.chunk) for r in rows] == [
        (0, None, None, None, "intro"), (1, "A", None, None, "text a"), (2, "A", "B", None, "text b"),
        (3, "A", "B", "C", "text c"), (4, "A", "D", None, "text d\n```\n# not a header\n```"),
        (5, "F", None, None, "#### deep\ntext f")]


def parts(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return {r.id: r for r in K.smart_parts(df, **options).collect()}


def test_smart_chunks_pass_or_fall_back_as_a_whole(spark):
    shifting = "Servers were updated. Gateways work. Penguins live in the south. Pools are tuned."
    massive = " ".join(["the same words come again and again in this long text."] * 9)
    wordless = "A sentence here. ?! ... And one more there."
    done = parts(spark, [shifting, massive, wordless, "", "One sentence only."],
                 max_size=150, fallback_size=100, fallback_overlap=10)
    assert not done[0].used_fallback and " ".join(done[0].smart) == shifting
    assert done[1].used_fallback and done[1].smart == K.split_text(massive, 100, 10)
    assert done[2].used_fallback and done[2].smart == [wordless]
    assert done[3].smart == [] and done[4].smart == ["One sentence only."]


def test_smart_chunk_query_keeps_every_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    semantic = {}
    for r in QUERIES["semantic_chunk"](spark, SF).collect():
        semantic.setdefault(r.doc_id, {})[r.chunk_no] = r.chunk
    smart, fallback = {}, {}
    for r in QUERIES["smart_chunk"](spark, SF).collect():
        smart.setdefault(r.doc_id, {})[r.chunk_no] = r.chunk
        fallback[r.doc_id] = r.used_fallback
    assert {i for i, t in docs.items() if t.strip()} == set(smart)
    for i, chunks in smart.items():
        ordered = [chunks[n] for n in sorted(chunks)]
        whole = [semantic[i][n] for n in sorted(semantic[i])]
        if fallback[i]:
            assert ordered == K.split_text(docs[i], 500, 50)
        else:
            assert ordered == whole and max(map(len, whole)) <= 1000


def test_children_lie_in_their_parents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parents, children = K.parent_child(docs)
    held = {(r.doc_id, r.parent_no): r for r in parents.collect()}
    rows = children.collect()
    assert len({(r.doc_id, r.parent_no, r.child_no) for r in rows}) == len(rows)
    for r in rows:
        assert r.child in held[r.doc_id, r.parent_no].parent and len(r.child) <= 150
    assert {(r.doc_id, r.parent_no) for r in rows} == set(held)


def test_parent_with_more_than_1024_children(spark):
    docs = spark.createDataFrame([(1, "word " * 4000)], "doc_id bigint, text string")
    _, children = K.parent_child(docs, parent=(9000, 0), child=(6, 0))
    rows = children.select("doc_id", "parent_no", "child_no").collect()
    assert len(set(rows)) == len(rows) == 4000


@pytest.mark.parametrize("ids", [[2**33, 2**62, -5], ["b", "a", "é"]])
def test_parents_of_any_document_id(spark, ids):
    texts = ["green apples grow", "blue whales swim", "red cars drive"]
    kind = "string" if isinstance(ids[0], str) else "bigint"
    docs = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string")
    queries = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "query_id bigint, query string")
    found = R.parent_search(queries, docs, 1).collect()
    assert {r.query_id: (r.doc_id, r.parent) for r in found} == {n: (i, t) for n, (i, t) in enumerate(zip(ids, texts))}


def test_parents_come_in_best_child_order(spark):
    rows = QUERIES["parent_retrieve"](spark, SF).collect()
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
        assert r.parent_no >= 0 and r.parent
    for found in by_query.values():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
        assert found[0].best_child_rank == 1
        order = [r.best_child_rank for r in found]
        assert order == sorted(order)


def test_strategy_figures_add_up(spark):
    stats = {(r.strategy, r.lang): r for r in QUERIES["chunk_strategy_stats"](spark, SF).collect()}
    counted = QUERIES["semantic_chunk"](spark, SF).groupBy("lang").agg(
        F.count("*").alias("n"), F.max("n_chars").alias("m")).collect()
    for r in counted:
        assert stats["semantic", r.lang].n_chunks == r.n and stats["semantic", r.lang].max_chars == r.m
    assert all(r.max_chars <= 150 for (s, _), r in stats.items() if s == "recursive")


def test_overlap_never_loses_text(spark):
    rows = {(r.overlap, r.lang): r for r in QUERIES["chunk_overlap"](spark, SF).collect()}
    for (overlap, lang), r in rows.items():
        if overlap:
            assert r.n_chars > rows[0, lang].n_chars


def test_ann_recall_query(spark):
    rows = QUERIES["ann_recall"](spark, SF).collect()
    assert np.mean([r.recall for r in rows]) > 0.4


def test_distinct_sources_keep_first_rank(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a")], "query_id int, rank int, f string")
    out = {(r.f, r.first_rank, r.source_no) for r in R.distinct_sources(df, ["f"]).collect()}
    assert out == {("a", 1, 1), ("b", 2, 2)}


def test_only_a_run_of_texts_is_held_as_strings():
    texts = pa.array(["some words of a text. " * 200, None, ""] * 3000)
    tracemalloc.start()
    found = K._chunk_lists(texts, 300, 30, K.PLAIN)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6_000_000 < texts.nbytes and found.type == pa.list_(pa.string())
    assert found.to_pylist()[-3:] == [K.split_text("some words of a text. " * 200, 300, 30), None, []]
    assert K._chunk_lists(pa.array([], pa.string()), 300, 30, K.PLAIN).to_pylist() == []
