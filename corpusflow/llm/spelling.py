"""Spelling variants: words one edit apart, found by Gram matrices of letter counts in blocks.

A replaced letter changes a word's letter counts by a squared distance of two at most, an inserted
or deleted one by one. So words are laid out in blocks by length, sorted by their letter counts;
one matrix product gives all squared distances between two blocks of equal or adjacent length, and
only pairs at most two apart are verified letter by letter. Two blocks whose ranges of letter
counts are more than two apart hold no such pair and are never multiplied, first for large blocks
(which meet in tasks) and then for the small ones inside them.

Each word then points to its most frequent near word if that is at least twice as frequent as
itself; the ends of these chains are found by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.ranking import number_rows

from .common import stored, utf8

RUN = re.compile("[a-zA-ZÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3  # of a word
FACTOR = 2        # a form is at least this many times as frequent
LARGE = 16_384    # words of a block that meets others in a task, for short words
SMALL = 256       # words of a block that is multiplied
LETTERS = 1 << 20  # of a large block at most (or one word)
HELD = 200_000    # words that a task counts before it passes them on
DIMS = 32         # letter classes: a to z, and six for the others
RANKED = "eanirtsoludcmpghbfvqywkjxz"  # letters by rough frequency, so that sorted words fall apart early


def damaged(doc_id: str, words: dict[str, int]) -> Iterator[tuple[str, int]]:
    """The words of one document, some of them with one letter lost, by a checksum of id and word."""
    lead = f"{doc_id}:"
    for word, n in words.items():
        h = zlib.crc32((lead + word).encode())
        if h % 97 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, n


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of all words with ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` places or more.

    Words are counted in each task first, in a table of bounded size, so a hot word is a few
    rows when it is shuffled.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for part in parts:
            for ident, body in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
                mine: dict[str, int] = {}
                for found in RUN.finditer(body.lower().decode("utf-8", "surrogatepass")):  # bytes: only A-Z change
                    word = found[0]
                    mine[word] = mine.get(word, 0) + 1
                for word, n in damaged(ident or "", mine):
                    if len(word) >= LEAST_LETTERS:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield passed()
                    held.clear()
        if held:
            yield passed()

    rows = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string"))
    return rows.mapInArrow(batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Block:
    """Words of one length with their letters and letter counts as arrays."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n, self.size = words, n, len(words[0])
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), self.size).astype(np.int32)
        kinds = np.where((self.codes >= 97) & (self.codes <= 122), self.codes - 97, 26 + self.codes % (DIMS - 26))
        exact = np.float32 if self.size < 2048 else np.float64  # squares must stay exact
        self.counts = np.zeros((len(words), DIMS), exact)
        np.add.at(self.counts, (np.repeat(np.arange(len(words)), self.size), kinds.ravel()), 1)
        self.squares = np.einsum("ij,ij->i", self.counts, self.counts)
        self.order = np.array(sorted(range(len(words)), key=lambda i: (-int(n[i]), words[i])))  # most frequent first
        self.rank = np.argsort(self.order)
        starts = np.arange(0, len(words), SMALL)
        self.low, self.high = np.minimum.reduceat(self.counts, starts), np.maximum.reduceat(self.counts, starts)


def apart(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """Least squared distance between points of two boxes, for all pairs of boxes."""
    out = np.zeros((len(low), len(low2)))
    for k in range(low.shape[1]):
        gap = np.maximum(low[:, None, k] - high2[None, :, k], low2[None, :, k] - high[:, None, k])
        np.maximum(gap, 0, out=gap)
        out += gap * gap
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters ``a`` and ``b``, of equal length or ``b`` longer by one, are one edit apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same_from_start = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    same_to_end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return same_from_start + same_to_end >= a.shape[1]


def near_pairs(a: Block, b: Block, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of words of ``a`` and ``b`` that are one edit apart; with ``itself`` each pair once."""
    close = apart(a.low, a.high, b.low, b.high) <= 2
    # -(squared distance) is one product of the counts with their squares beside them.
    ones = np.ones((len(b.words), 1), b.counts.dtype)
    right = np.concatenate([2 * b.counts, -ones, -b.squares[:, None]], axis=1).T.copy()
    left = np.concatenate([a.counts, a.squares[:, None], np.ones((len(a.words), 1), a.counts.dtype)], axis=1)
    step = max(1, LETTERS // a.size)
    for i in range(len(close)):
        mine = slice(i * SMALL, min((i + 1) * SMALL, len(a.words)))
        partners = np.flatnonzero(close[i])
        for j in partners[partners >= i].tolist() if itself else partners.tolist():
            x, y = np.nonzero(left[mine] @ right[:, j * SMALL:(j + 1) * SMALL] >= -2.5)
            x, y = x + i * SMALL, y + j * SMALL
            if itself:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), step):
                p, q = x[k:k + step], y[k:k + step]
                real = one_edit(a.codes[p], b.codes[q])
                if real.any():
                    yield p[real], q[real]


class _Best:
    """For each word of ``mine`` how many near words ``other`` has and the first of them in its order."""

    def __init__(self, mine: Block, other: Block):
        self.mine, self.other = mine, other
        self.count = np.zeros(len(mine.words), np.int64)
        self.best = np.full(len(mine.words), len(other.words))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.count += np.bincount(i, minlength=len(self.count))
        np.minimum.at(self.best, i, self.other.rank[j])

    def rows(self) -> pa.RecordBatch:
        met = np.flatnonzero(self.count)
        best = self.other.order[self.best[met]]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.mine.words[i] for i in met], pa.string()), pa.array(self.count[met]), pa.array(self.other.n[best], pa.int64()),
             pa.array([self.other.words[j] for j in best], pa.string())], ["word", "n_near", "near_n", "near"])


NEAR = "word string, n_near long, near_n long, near string"


def _meet(pair: pa.Table) -> pa.Table:
    """Near words of one pair of large blocks (or of one block within itself)."""
    row = {c: pair.column(c)[0] for c in pair.column_names}
    a = Block(row["words"].as_py(), row["ns"].values.to_numpy())
    itself = row["block"] == row["other"]
    b = a if itself else Block(row["other_words"].as_py(), row["other_ns"].values.to_numpy())
    of_a, of_b = _Best(a, b), _Best(b, a)
    for i, j in near_pairs(a, b, itself):
        of_a.add(i, j)
        (of_a if itself else of_b).add(j, i)
    return pa.Table.from_batches([of_a.rows()] if itself else [of_a.rows(), of_b.rows()])


def _boxes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of letter counts of each large block."""
    for part in parts:
        low, high = [], []
        for words in part.column(2):  # one block at a time
            block = Block(words.as_py(), np.zeros(len(words)))
            low.append(block.low.min(axis=0).astype(np.int32).tolist())
            high.append(block.high.max(axis=0).astype(np.int32).tolist())
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(low, pa.list_(pa.int32())), pa.array(high, pa.list_(pa.int32()))],
                                         ["block", "letters", "low", "high"])


def blocks_of(words: DataFrame, large: int = LARGE) -> DataFrame:
    """``(block, letters, words, ns)`` of ``words(word, n)``: equal length, sorted by letter counts."""
    plain = "".join(chr(97 + i) for i in range(len(RANKED)))
    profile = F.array_join(F.array_sort(F.split(F.translate("word", RANKED, plain), "")), "")
    sized = words.select("word", "n", F.char_length("word").alias("letters"), profile.alias("profile"))
    placed = number_rows(sized, [F.col("profile"), F.col("word")], ["letters"], "place")
    held = F.greatest(F.lit(1), F.least(F.lit(large), F.floor(F.lit(LETTERS) / F.col("letters"))))
    number = F.floor((F.col("place") - 1) / held).cast("long")
    rows = placed.select("letters", number.alias("part"), F.struct("place", "word", "n").alias("w"))
    each = rows.groupBy("letters", "part").agg(F.sort_array(F.collect_list("w")).alias("w"))  # ``held`` words at most
    return each.select(F.struct("letters", "part").alias("block"), "letters", F.col("w.word").alias("words"), F.col("w.n").alias("ns"))


def near_words(words: DataFrame, large: int = LARGE) -> DataFrame:
    """``(word, n_near, near_n, near)`` of all words of ``words(word, n)`` that have a near one.

    ``near`` is the most frequent near word, the first by code points among equals.
    """
    blocks = stored(blocks_of(words, large), "spelling-blocks")
    boxes = stored(blocks.select("block", "letters", "words").mapInArrow(_boxes, "block struct<letters:int,part:bigint>, letters int, low array<int>, high array<int>"),
                   "spelling-boxes")
    other = boxes.select(F.col("block").alias("other"), F.explode(F.array(F.col("letters") - 1, F.col("letters"))).alias("letters"),
                         F.col("low").alias("low2"), F.col("high").alias("high2"))
    gap = F.zip_with(F.zip_with("low", "high2", lambda a, b: a - b), F.zip_with("low2", "high", lambda a, b: a - b),
                     lambda a, b: F.greatest(a, b, F.lit(0)))
    far = F.aggregate(gap, F.lit(0), lambda total, g: total + g * g)
    pairs = boxes.join(other, "letters").where((F.col("other") >= F.col("block")) & (far <= 2)).select("block", "other")
    pairs = stored(pairs, "spelling-pairs")
    left = pairs.join(blocks.select("block", "words", "ns"), "block")
    both = left.join(blocks.select(F.col("block").alias("other"), F.col("words").alias("other_words"), F.col("ns").alias("other_ns")), "other")
    met = both.groupBy("block", "other").applyInArrow(_meet, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("near_n"), F.col("b.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: where the chain of forms ends.

    Each round doubles the length of the steps. A form is at least twice as frequent as its word,
    so chains are at most the logarithm of the largest count long and rounds the logarithm of that.
    """
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        step = stored(step, "spelling-roots")
        further = step.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        if step.join(further, F.col("root") == F.col("_w"), "left_semi").isEmpty():
            return step
        step = step.join(further, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word with its near words, its form and the root of its form.

    A null text has no words; a null id counts as an empty one. Repeated rows count each time,
    ties of frequency go to the first word by code points. Runs of any length are words. Other
    columns are not read; an empty table gives an empty result.
    """
    words = stored(word_counts(docs, doc_id, text), "spelling-words")
    near = stored(near_words(words), "spelling-near")
    told = words.join(near, "word", "left")
    usual = F.col("near_n") >= FACTOR * F.col("n")
    told = told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(usual, F.col("near")).alias("form"),
                       F.when(usual, F.col("near_n")).alias("form_n"))
    told = stored(told, "spelling-forms")
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
