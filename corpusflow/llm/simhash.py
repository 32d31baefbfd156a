"""SimHash near-duplicates by a self-join of a binary trie.

The trie is cut at a depth that follows from the number of fingerprints into bounded blocks of
consecutive fingerprints. Pairs of blocks whose prefixes are within the error budget are joined,
and each pair is descended in its task: pairs of trie nodes go down together, differing bits add
up, and a pair over the budget is dropped with all below it.

Four errors in 64 bits leave at most two in one of the two halves. So the join runs twice, once
with each half as the upper part of the trie, with a budget of two in the upper half and of four
in all: the same links, at a fraction of the node pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.sizing import broadcast_if_small

from .common import in_groups, stored, utf8
from .components import connected

HALF = 32
BLOCK = 16_384  # fingerprints of one trie block, so a task holds two such blocks
CHECK = 32      # node pairs with at most so many fingerprint pairs are checked, not descended
TEXTS = 1 << 20  # bytes of texts hashed at once in a task
HASHES = 1 << 14  # hashes whose bits are counted at once
STEP = 1 << 19  # node or fingerprint pairs handled at once in a task


def _hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles of a text; one of the whole if it has fewer words."""
    words = text.lower().split()  # of bytes: A-Z alone are lowered, ASCII white space alone splits
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1:].tolist(), strict=True)), np.uint64, len(starts))


def _bits(hashes) -> np.ndarray:
    return np.unpackbits(np.asarray(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def majority(groups: list) -> np.ndarray:
    """One fingerprint per list: bits set in over half of its hashes; zero for an empty list."""
    out = np.zeros(len(groups), np.uint64)
    for a, b in in_groups([len(g) for g in groups], HASHES):
        full = [i for i in range(a, b) if len(groups[i])]
        if not full:
            continue
        counts = np.array([len(groups[i]) for i in full])
        if len(full) == 1:  # a long text comes alone, and in pieces
            set_bits = sum(_bits(groups[full[0]][at:at + HASHES]).sum(axis=0, dtype=np.int64) for at in range(0, counts[0], HASHES))[None, :]
        else:
            flat = _bits(np.concatenate([np.asarray(groups[i], np.uint64) for i in full]))
            set_bits = np.add.reduceat(flat, np.cumsum(counts) - counts, axis=0, dtype=np.int32)
        out[full] = np.packbits(set_bits * 2 > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the 64 bits as a signed long."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            column = part.column(1)
            fps = np.zeros(len(column), np.uint64)
            # Only a run of texts is held as Python objects, whatever the rows of a batch.
            for a, b in in_groups(pc.binary_length(column).fill_null(0).to_pylist(), TEXTS):
                fps[a:b] = majority([_hashes(t, width) for t in utf8(column.slice(a, b - a))])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return docs.mapInArrow(batches, "doc_id long, fp long")


def _blocks(nodes: DataFrame, depth: int) -> DataFrame:
    """Trie blocks ``(turn, prefix, part, fps)``; a prefix over the block size has several parts."""
    turned = [nodes.select(F.lit(turn).alias("turn"), "fp", key.alias("key")) for turn, key in (
        (0, F.col("fp")), (1, F.shiftleft("fp", HALF).bitwiseOR(F.shiftrightunsigned("fp", HALF))))]
    prefix = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    rows = turned[0].unionByName(turned[1]).select("turn", prefix.alias("prefix"), "key")
    heavy = (rows.groupBy("turn", "prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
             .select("turn", "prefix", F.ceil(F.col("n") / BLOCK).alias("parts")))
    rows = rows.join(broadcast_if_small(heavy), ["turn", "prefix"], "left")
    part = F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1)))
    return (rows.withColumn("part", part).groupBy("turn", "prefix", "part")
            .agg(F.sort_array(F.collect_list("key")).alias("fps")))


def _block_pairs(blocks: DataFrame, depth: int, upper: int) -> DataFrame:
    """Pairs of blocks whose prefixes differ in at most ``upper`` bits, each pair once."""
    bits = [1 << i for i in range(depth)]
    masks = [0, *bits] if upper >= 1 else [0]
    if upper >= 2:
        masks += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    keys = blocks.select("turn", "prefix", "part")
    reach = keys.select("turn", F.col("prefix").alias("a"), F.col("part").alias("a_part"), F.explode(
        F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("prefix").bitwiseXOR(m))).alias("b"))
    return (reach.join(keys.select("turn", F.col("prefix").alias("b"), F.col("part").alias("b_part")), ["turn", "b"])
            .where("a < b or (a = b and a_part <= b_part)"))


def _descend(a: np.ndarray, b: np.ndarray, same: bool, upper: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two sorted blocks within the budget, found by descending both tries together.

    Pending node pairs are a stack of bounded pieces, so memory stays small whatever the shape
    of the tries. In a self-join each pair comes once.
    """
    one = np.uint64(1)
    def span(x):
        return np.array([[0], [len(x)]], np.int64)
    stack = [(63, np.concatenate([span(a), span(b)]), np.zeros(1, np.int8))]
    while stack:
        bit, nodes, err = stack.pop()
        small = (nodes[1] - nodes[0]) * (nodes[3] - nodes[2]) <= CHECK
        if bit < 0:
            small[:] = True
        if small.any():
            yield from _check(a, b, nodes[:, small], same, budget, upper)
            nodes, err = nodes[:, ~small], err[~small]
        if not nodes.shape[1]:
            continue
        cuts = []
        for x, lo, hi in ((a, nodes[0], nodes[1]), (b, nodes[2], nodes[3])):
            high = (((x[lo] >> np.uint64(bit)) | one) << np.uint64(bit))  # least value with this bit set
            cuts.append(np.clip(np.searchsorted(x, high), lo, hi))
        (a0, a1, b0, b1), (ca, cb) = nodes, cuts
        kids = [(a0, ca, b0, cb, 0), (ca, a1, cb, b1, 0), (a0, ca, cb, b1, 1), (ca, a1, b0, cb, 1)]
        limit = upper if bit >= HALF else budget
        found = []
        for k, (p, q, r, s, more) in enumerate(kids):
            keep = (q > p) & (s > r) & (err + more <= limit)
            if same and k == 3:  # of a node with itself, one of the two mixed pairs is enough
                keep &= ~((a0 == b0) & (a1 == b1))
            found.append((np.stack([p, q, r, s])[:, keep], err[keep] + np.int8(more)))
        nodes = np.concatenate([f[0] for f in found], axis=1)
        err = np.concatenate([f[1] for f in found])
        for i in range(0, nodes.shape[1], STEP // 4):
            stack.append((bit - 1, nodes[:, i:i + STEP // 4], err[i:i + STEP // 4]))


def _check(a, b, nodes, same, budget, upper) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All fingerprint pairs of small node pairs, a bounded number at a time."""
    width = nodes[3] - nodes[2]
    counts = (nodes[1] - nodes[0]) * width
    ends = np.cumsum(counts)
    done = 0
    while done < len(counts):
        stop = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + STEP)), done + 1)
        c = counts[done:stop]
        which = np.repeat(np.arange(done, stop), c)
        at = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        i, j = nodes[0][which] + at // width[which], nodes[2][which] + at % width[which]
        keep = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            keep &= i < j
        yield i[keep], j[keep]
        done = stop


class _Forest:
    """Union-find over the fingerprints of one block pair, a batch of links at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            y = self.up[x]
            if np.array_equal(x, y):
                return x
            x = y

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.roots(i), self.roots(j)
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.up, np.maximum(i, j), np.minimum(i, j))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(len(self.up))
        root = self.roots(at)
        return at[root != at], root[root != at]


def _turn_back(x: np.ndarray, turn: int) -> np.ndarray:
    return (x << np.uint64(HALF)) | (x >> np.uint64(HALF)) if turn else x


def block_links(a: np.ndarray, b: np.ndarray, same: bool, upper: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components as all pairs of the two blocks within the budget."""
    forest = _Forest(len(a) if same else len(a) + len(b))
    for i, j in _descend(a, b, same, upper, budget):
        forest.add(i, j if same else j + len(a))
    all_fps = a if same else np.concatenate([a, b])
    i, j = forest.links()
    return all_fps[i], all_fps[j]


def trie_links(nodes: DataFrame, budget: int = 4) -> DataFrame:
    """``(u, v)`` fingerprint pairs within ``budget`` bits that span all components.

    ``nodes(fp)`` are distinct. Of a dense group only a spanning forest per block pair leaves the
    task, never its pairs.
    """
    if not 0 <= budget < 6:
        raise ValueError("the two-half split covers budgets of 0 to 5 bits")
    upper = budget // 2
    n = nodes.count()
    depth = min(max((n // BLOCK).bit_length(), 0), HALF)
    blocks = stored(_blocks(nodes, depth), "trie")
    pairs = _block_pairs(blocks, depth, upper)
    left = blocks.select("turn", F.col("prefix").alias("a"), F.col("part").alias("a_part"), F.col("fps").alias("a_fps"))
    right = blocks.select("turn", F.col("prefix").alias("b"), F.col("part").alias("b_part"), F.col("fps").alias("b_fps"))
    work = pairs.join(left, ["turn", "a", "a_part"]).join(right, ["turn", "b", "b_part"])
    same = (F.col("a") == F.col("b")) & (F.col("a_part") == F.col("b_part"))
    work = work.select("turn", same.alias("same"), "a_fps", F.when(~same, F.col("b_fps")).alias("b_fps"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                turn, same = part.column(0)[k].as_py(), part.column(1)[k].as_py()
                a = np.sort(part.column(2)[k].values.to_numpy(zero_copy_only=False).view(np.uint64))
                b = a if same else np.sort(part.column(3)[k].values.to_numpy(zero_copy_only=False).view(np.uint64))
                u, v = (_turn_back(x, turn).view(np.int64) for x in block_links(a, b, same, upper, budget))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    pieces = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    spread = work.repartition(pieces, F.xxhash64("turn", F.size("a_fps"), F.element_at("a_fps", 1), F.element_at("b_fps", 1)))
    return spread.mapInArrow(batches, "u long, v long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4,
                    budget: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    Words are runs without ASCII white space after lowering A-Z; shingles are ``width`` words,
    repeats included. Fingerprints within ``budget`` bits are linked, and ``component_id`` is the
    least ``doc_id`` reachable over links. Equal fingerprints are one trie entry, so copies cost
    one entry however many they are.

    Null or blank texts have fingerprint zero and link like any other. Rows without an id share
    the component of their fingerprint and never give it its name; it is null if none has an id.
    Repeated rows each give a row. An empty table gives an empty result. Other columns are not read.
    """
    rows = stored(fingerprints(docs, doc_id, text, width), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "trie-entries")
    roots = connected(trie_links(nodes.select("fp"), budget)).withColumnRenamed("node", "fp")
    linked = roots.join(nodes, "fp")
    named = linked.groupBy("root").agg(F.min("least").alias("named"))
    labels = nodes.join(linked.select("fp", "root").join(named, "root").select("fp", "named"), "fp", "left")
    # Written first, so that the join below stands alone and a fingerprint of very many copies can be split.
    labels = stored(labels.select("fp", F.coalesce("named", "least").alias("component_id")), "components")
    return rows.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
