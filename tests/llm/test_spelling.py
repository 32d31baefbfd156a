"""Spelling variants against deletion neighbourhoods of the whole vocabulary, and against plain counting."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import spelling

DOCS = "doc_id long, text string, word string, n int"


def brute_words(rows):
    """The words of the contract, place by place."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1:]
            n[low] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute_near(words):
    """Words one edit apart share a word with one letter deleted, or one is the other so shortened."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            short = w[:k] + w[k + 1:]
            holes[k, short].add(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(rows):
    words = brute_words(rows)
    near = brute_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = {}
    for w in words:
        end = w
        while form[end]:
            end = form[end]
        out[w] = (form[w], end, words[w], len(near[w]), words.get(form[w]))
    return out


def run(frame, rows):
    got = spelling.variants(frame([(*r, "x", 1) for r in rows], DOCS)).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(out) == len(got)
    return out


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).collect()}
    assert got == want and sum(v[0] is not None for v in want.values()) > 100


ODD = [(1, "Letter letter LETTER lettre"), (2, "letters " * 7 + "léttér " * 3), (3, None), (4, ""), (None, "letters lettér lettér lettér"),
       (5, "élève ÉLÈVE élève " * 3), (5, "élève ÉLÈVE élève " * 3), (6, "abcde " * 12 + "abcdf " * 6 + "abcgf " * 3 + "abcdg " * 6),
       (7, ("x" * 3000 + " ") * 3 + ("x" * 2999 + " ") * 8 + ("x" * 1500 + "y" + "x" * 1498 + " ") * 4), (8, "aaaaa " * 4 + "aaaaaa " * 4 + "÷÷÷÷÷ " * 3),
       (9, "anele elena lenae " * 3), (10, "word-break under_score don't " * 3)]


def test_odd_rows(frame):
    got = run(frame, ODD)
    assert got == brute(ODD)
    assert got["abcgf"][:2] == ("abcdf", "abcde") and got["x" * 3000][1] == "x" * 2999
    assert run(frame, []) == {} and run(frame, [(1, "short is not here"), (2, None)]) == {}


def test_many_blocks_find_the_same_pairs(frame, monkeypatch):
    monkeypatch.setattr(spelling, "SMALL", 8)
    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("abé"), rng.integers(5, 8))): int(rng.integers(3, 9)) for _ in range(400)}
    near = brute_near(words)
    got = {r.word: (r.n_near, r.near_n, r.near) for r in spelling.near_words(frame(list(words.items()), "word string, n long"), large=30).collect()}
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    assert got == {w: (len(near[w]), words[b], b) for w, b in best.items()}


@pytest.mark.parametrize(("a", "b", "real"), [("abcde", "abcdf", 1), ("abcde", "abcde", 0), ("abcde", "abced", 0), ("abcde", "abcxde", 1), ("abcde", "xabcde", 1),
                                              ("abcde", "abcdex", 1), ("aaaaa", "aaaaaa", 1), ("abcde", "abdcex", 0), ("abcde", "edcbaa", 0)])
def test_one_edit(a, b, real):
    codes = lambda w: np.array([[ord(c) for c in w]])
    assert bool(spelling.one_edit(codes(a), codes(b))[0]) == bool(real)


def test_long_chains_of_forms(frame):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(21)]
    assert {r.word: r.root for r in spelling.roots(frame(chain, "word string, form string")).collect()} == {f"w{i}": "w21" for i in range(21)}
