"""The filter audit against applying every order of the filters to every document."""

import re
from collections import defaultdict
from itertools import permutations

from corpusflow.llm import filter_audit

DOCS = "doc_id long, text string, source string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int"


def failing(docs):
    """Filters that each row fails, by their definitions."""
    out = []
    for doc_id, text, *_ in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        early = [i for i, t, *_ in docs if i is not None and doc_id is not None and i < doc_id and (t or "") == body]
        out.append({f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", body)) > 2 * len(body),
            re.search(r"[#$%&*|]", body), early), strict=True) if bad})
    return out


def brute(docs, labels):
    """Every row is sent through every order, filter by filter."""
    fails = failing(docs)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for k, row in enumerate(docs):
        parts[row[2] or ""].append(k)
    out = {}
    for part, rows in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                before = set(order[:step - 1])
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in fails[k] and bool(fails[k] & before) for k in rows), sum(fails[k] == {f} for k in rows),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone)]
                shapley[f] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def run(frame, docs, labels):
    got = filter_audit.audit(frame([(*d, 1, "x") for d in docs], DOCS), frame(labels, LABELS)).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got}
    assert len(out) == len(got)
    return out


def test_intervals_tell_the_step_of_every_order():
    for mask in range(32):
        said = {}
        for step, first, past in filter_audit.intervals(mask):
            assert not said.keys() & set(range(first, past))
            said |= dict.fromkeys(range(first, past), step)
        want = {k: next(i for i, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1)
                for k, order in enumerate(filter_audit.ORDERS) if mask}
        assert said == want
    assert filter_audit.ORDERS == sorted(filter_audit.ORDERS) and len(set(filter_audit.ORDERS)) == 120


def test_matches_brute_force_on_documents(spark, documents):
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = filter_audit.audit(documents, labels).collect()
    want = brute(docs, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in got} == want and len(got) == len(want)


def test_odd_rows(frame):
    long = " ".join(f"w{i}" for i in range(250))
    docs = [(1, long, "a"), (2, long, "a"), (2, long, "b"), (3, None, None), (4, "", ""), (None, long, "a"), (None, None, None), (5, "A B C", "a"),
            (6, long + " É # x", "a"), (7, "one " * 100_000, "b"), (8, "\x0b\x0c \t", "b"), (9, long + "\x0b" + long.upper(), "b"), (9, "|", "b")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (5, None, None), (7, 1, 1), (99, 1, 1)]
    got = run(frame, docs, labels)
    assert got == brute(docs, labels) and {p for p, _, _ in got} == {"", "a", "b"} and len(got) == 1800


def test_shares_of_the_filters_add_up(frame):
    docs = [(i, f"{'X' * (i % 3)} {i % 4} {'#' * (i % 2)}", "s") for i in range(40)]
    got = run(frame, docs, [])
    removed = 40 - got["s", "ABCDE", 5][0]
    assert sum(got["s", o, 1][6] for o in ("ABCDE", "BACDE", "CABDE", "DABCE", "EABCD")) == 120 * removed


def test_empty_tables(frame):
    assert run(frame, [], [(1, 1, 1)]) == {}
    assert len(run(frame, [(1, "x", "a")], [])) == 600
