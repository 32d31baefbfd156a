"""Targets against plain water filling; what pivotal rounding keeps."""

from collections import Counter, defaultdict

import pytest

from corpusflow.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def water_filled(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 3, None: 70}, {"x": 5}, {"a": 0, "b": 0},
                                   {f"s{i}": (i * 37) % 101 for i in range(20)}, {"é": 7, "z": 900, "Z": 40, "": 3}])
def test_targets(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = water_filled(sizes)
    assert {r.source for r in got} == set(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r.source] if sum(sizes.values()) else 0.0)


def test_documents_come_near_their_targets(documents):
    rows = mixing.copies(documents).collect()
    texts = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    assert len(rows) == len(texts)
    sizes = defaultdict(int)
    for text, source in texts.values():
        sizes[source] += len((text or "").split())
    want = water_filled(sizes)
    taken, count, odds, most = Counter(), Counter(), Counter(), Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id][0].split()) and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
        count[r.source] += r.copies
        odds[r.source] += r.target / r.source_size
        most[r.source] = max(most[r.source], r.size)
    for s in sizes:
        assert abs(count[s] - odds[s]) < 1  # fights keep the number of copies
        assert abs(taken[s] - want[s]) <= 2 * most[s]


def test_reruns_agree(documents):
    def run(data):
        return sorted((r.doc_id, r.taken) for r in mixing.copies(data).collect())
    assert run(documents.coalesce(1)) == run(documents.repartition(5))


def test_every_level_of_the_tree_keeps_the_sum(spark):
    for p, n in ((0.3, 700), (0.75, 333), (0.5, 1), (1 / 3, 129)):
        units = spark.range(1, n + 1).selectExpr("0 AS source_no", "id AS rank", f"double({p}) AS p")
        won = [r["rank"] for r in mixing.rounded(units, n, run=4).collect()]
        assert len(won) == len(set(won)) and abs(len(won) - p * n) < 1


def test_draws_are_fair(spark):
    hits = Counter()
    for seed in range(60):
        units = spark.range(1, 11).selectExpr("0 AS source_no", "id AS rank", "0.4D AS p")
        hits.update(r["rank"] for r in mixing.rounded(units, 10, seed=seed, run=16).collect())
    assert sum(hits.values()) == 240 and all(8 <= hits[i] <= 42 for i in range(1, 11))


def test_odd_rows(frame):
    rows = [(1, None, "a"), (2, "", "a"), (3, "w " * 50_000, "b"), (4, "one two", None), (4, "one two", None), (None, "x y z", None),
            (5, "same", "c"), (6, "same", "c")]
    data = frame([(*r, 1, 2) for r in rows], SCHEMA + ", taken int, rank int")
    got = mixing.copies(data).collect()
    assert sorted((r.size for r in got)) == [0, 0, 1, 1, 2, 2, 3, 50_000]
    assert all(r.taken <= 2 * r.size for r in got)
    out = mixing.mixed(data)
    assert out.columns == data.columns
    assert out.count() == sum(r.copies for r in got)
    assert mixing.copies(frame([], SCHEMA)).collect() == [] and mixing.mixed(frame([], SCHEMA)).collect() == []
