"""SimHash groups against all pairs and hand-made fingerprints."""

import random
import re
import tracemalloc

import numpy as np
import xxhash

from corpusflow.llm import simhash
from corpusflow.llm.components import connected

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_documents_match_all_pairs(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    groups = brute_components(fps)
    got = simhash.near_duplicates(documents).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {i: (fps[i], groups[i]) for i in texts}


def test_odd_rows(frame):
    long = " ".join(f"w{i % 977}é" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, long), (7, long), (7, long), (None, long),
            (None, "only here, without an id"), (8, "one two three four five")]
    got = simhash.near_duplicates(frame([(*r, "x") for r in rows], SCHEMA + ", component_id string")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == {("0" * 16, 1)}
    assert {c for _, c in by[5]} == {4} and {c for _, c in by[7]} == {6} and {c for _, c in by[8]} == {8}
    assert {c for _, c in by[None]} == {6, None}


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([], SCHEMA)).collect() == []


def test_trie_finds_every_link_of_dense_and_random_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)  # many blocks, also of one prefix
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(300)} | {centre}
    for _ in range(500):  # a ball around one fingerprint, denser than a block
        fp = centre
        for _ in range(rng.randrange(1, 7)):
            fp ^= 1 << rng.randrange(64)
        fps.add(fp)
    for fp in list(fps)[:100]:  # pairs at exactly four and five bits, over both halves
        for n in (4, 5):
            other = fp
            for b in rng.sample(range(64), n):
                other ^= 1 << b
            fps.add(other)
    signed = {fp: fp - (1 << 64 if fp >> 63 else 0) for fp in fps}
    nodes = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = connected(simhash.trie_links(nodes)).collect()
    root = {r.node: r.root for r in links}
    want = brute_components({signed[fp]: fp for fp in fps})
    for fp in signed.values():
        assert root.get(fp, fp) == want[fp]


def test_descend_yields_each_pair_once():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 32, 400, dtype=np.uint64)
    a = np.unique(np.concatenate([base, base[rng.integers(0, 40, 400)] ^ flips]))
    pairs = [(int(x), int(y)) for i, j in simhash._descend(a, a, True, 4, 4) for x, y in zip(i, j, strict=True)]
    want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 4}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_components_of_chain_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 200), (150, 149)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_hashes_and_their_bits_take_bounded_memory():
    group = simhash._hashes(b" ".join(b"%d" % i for i in range(200_000)), 4)
    assert group.dtype == np.uint64 and len(group) == 199_997
    groups = [group[a:a + 1000] for a in range(0, len(group), 1000)]
    tracemalloc.start()
    found = simhash.majority(groups)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000 and found[3] == simhash.majority([groups[3].tolist()])[0]
