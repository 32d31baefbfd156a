"""Toxicity: subword-bag embeddings averaged under a linear softmax, learned jointly in numpy.

A word is the mean of the vectors of its hashed character n-grams and a window of ``SPAN``
neighbouring words the mean of theirs, so a misspelling shares most vectors with the word it
bends. A document counts as toxic if any of its windows does: its raw score is the largest
logit over all windows of the whole text. Learning knows labels of documents only, so it first
takes every window for its document's label, and then again and again the windows of toxic
documents that the model itself finds worst. A logistic curve fitted on documents kept out of the
descent, weighted to the share of toxic documents among all labels, makes raw scores
probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusflow.plans.sizing import broadcast_if_small, materialise

from .common import fold_of
from .subword import alphabet, chosen, grams, pieces

ORDERS = (3, 6)         # lengths of n-grams
BITS = 18               # log2 of the number of buckets
WIDTH = 8               # of a vector
SPAN = 4                # words of a window
EXTRA = "0123456789@$*"  # signs that stand in for letters
SAMPLE = 3000           # labelled documents that the model learns from, about
LETTERS = 40_000_000    # characters of the sample together; documents past that are not drawn
LIMIT = 0.3             # score from which a document is predicted toxic


@dataclass
class ToxicityModel:
    scores: np.ndarray  # logit of each bucket, with a zero for "no n-gram"
    slope: float
    shift: float

    def predict(self, texts: list[str]) -> np.ndarray:
        raw = worst(texts, self.scores)
        there = np.isfinite(raw)  # a text without words says nothing: the low end of the curve, whatever the share of labels
        z = np.where(there, self.slope * np.where(there, raw, 0.0) + self.shift, -30.0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def words_of(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and which span it is in."""
    full = codes != 0
    at = np.flatnonzero(full[1:] & ~full[:-1]) + 1
    return at, np.searchsorted(starts, at, side="right") - 1


def worst(texts: list[str], scores: np.ndarray) -> np.ndarray:
    """Largest window logit of each text; minus infinity without words."""
    out = np.full(len(texts), -np.inf)
    for codes, owners, starts in pieces(texts, alphabet(EXTRA)):
        at, span = words_of(codes, starts)
        if not len(at):
            continue
        total, seen = np.zeros(len(codes)), np.zeros(len(codes))
        for g in grams(codes, *ORDERS, BITS):
            total[:len(g)] += scores[g]
            seen[:len(g)] += g < 1 << BITS
        # n-grams of a word begin at the gap before it or inside it
        logit = np.add.reduceat(total, at - 1) / np.maximum(np.add.reduceat(seen, at - 1), 1)
        sums = np.concatenate([[0.0], np.cumsum(logit)])
        first = np.searchsorted(span, span)                 # of the word's span
        stop = np.searchsorted(span, span, side="right")
        end = np.arange(1, len(at) + 1)
        begin = np.maximum(end - SPAN, first)
        whole = (end - begin == SPAN) | (end == stop)       # shorter windows only for shorter texts
        value = np.where(whole, (sums[end] - sums[begin]) / (end - begin), -np.inf)
        np.maximum.at(out, owners[span], value)
    return out


class _Words:
    """Distinct words of a sample with their n-grams, and the windows of each document."""

    def __init__(self, texts: list[str]):
        ids: dict[bytes, int] = {}
        self.grams: list[np.ndarray] = []
        window_docs, window_words = [], []
        for codes, owners, starts in pieces(texts, alphabet(EXTRA)):
            at, span = words_of(codes, starts)
            kinds = list(grams(codes, *ORDERS, BITS))
            ends = np.concatenate([at[1:], [len(codes)]])
            word_ids = np.empty(len(at), np.int32)
            for k, (a, b) in enumerate(zip(at.tolist(), ends.tolist(), strict=True)):
                key = codes[a:b].tobytes().rstrip(b"\0")
                if key not in ids:
                    ids[key] = len(ids)
                    got = np.concatenate([g[a - 1:b - 1] for g in kinds])
                    self.grams.append(got[got < 1 << BITS])
                word_ids[k] = ids[key]
            for k in range(len(owners)):
                mine = word_ids[span == k] if len(owners) < 8 else word_ids[np.searchsorted(span, k):np.searchsorted(span, k + 1)]
                for a in range(0, max(len(mine) - SPAN // 2, 1) if len(mine) else 0, SPAN // 2):
                    part = mine[a:a + SPAN]
                    window_docs.append(owners[k])
                    window_words.append(np.pad(part, (0, SPAN - len(part)), constant_values=-1))
        self.docs = np.array(window_docs, np.int64)
        self.words = np.array(window_words, np.int32).reshape(-1, SPAN)
        self.sizes = np.array([len(g) for g in self.grams], np.int64)
        self.flat = np.concatenate(self.grams) if self.grams else np.zeros(0, np.int32)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def logits(self, scores: np.ndarray) -> np.ndarray:
        word = np.add.reduceat(scores[self.flat], self.begin) / self.sizes if len(self.flat) else np.zeros(1)
        there = self.words >= 0
        return (word[self.words] * there).sum(axis=1) / there.sum(axis=1)

    def of(self, word_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of some words behind one another, and where each word's begin."""
        sizes = self.sizes[word_ids]
        begin = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.begin[word_ids] - begin, sizes) + np.arange(sizes.sum())], begin


def learn(texts: list[str], labels: np.ndarray, share: float, rounds: int = 5, seed: int = 3) -> ToxicityModel:
    """Stochastic descent over windows, repeated as the model tells toxic windows from the others."""
    zero = ToxicityModel(np.zeros((1 << BITS) + 1, np.float32), 1.0, -30.0 if not labels.any() else 0.0)
    if len(set(labels.tolist())) < 2:
        return zero
    data = _Words(texts)
    rng = np.random.default_rng(seed)
    kept_out = np.arange(len(texts)) % 4 == 3
    window_label = labels[data.docs]
    usable = ~kept_out[data.docs]
    e = np.zeros((1 << BITS, WIDTH), np.float32)
    e_seen = np.full(1 << BITS, 1e-8, np.float32)
    w = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    for turn in range(rounds):
        use = usable.copy()
        logit = None
        if turn:
            logit = data.logits(np.append(e @ (w[:, 1] - w[:, 0]), np.float32(0)))
            worst_of = np.full(len(texts), -np.inf)
            np.maximum.at(worst_of, data.docs, logit)
            keep = logit >= worst_of[data.docs] - 0.2 * np.abs(worst_of[data.docs])  # the document's worst windows
            use &= (window_label == 0) | keep
        rows = np.flatnonzero(use)
        good, bad = rows[window_label[rows] == 0], rows[window_label[rows] == 1]
        if turn:  # the clean windows that look worst, and as many others
            most = 20 * max(len(bad), 1000)
            hard = good[np.argsort(-logit[good])[:most]]
            good = np.union1d(hard, rng.choice(good, min(most, len(good)), replace=False))
        weight = np.array([0.5 / max(len(good), 1), 0.5 / max(len(bad), 1)])
        rows = rng.permutation(np.concatenate([good, bad]))
        for a in range(0, len(rows), 4096):
            at = rows[a:a + 4096]
            there = data.words[at] >= 0
            ids, back = np.unique(data.words[at][there], return_inverse=True)
            flat, begin = data.of(ids)
            sizes = data.sizes[ids]
            vectors = np.add.reduceat(e[flat], begin, axis=0) / sizes[:, None]
            place = np.repeat(np.arange(len(at)), there.sum(axis=1))
            per = there.sum(axis=1)
            h = np.add.reduceat(vectors[back], np.cumsum(per) - per, axis=0) / per[:, None]
            y = window_label[at]
            z = h @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), y] -= 1
            p *= (weight[y] * len(rows) / len(at))[:, None]
            gh = (p @ w.T) / per[:, None]
            w -= np.float32(0.05) * (h.T @ p).astype(np.float32)
            gv = np.stack([np.bincount(back, gh[place, k], len(ids)) for k in range(WIDTH)], axis=1) / sizes[:, None]
            touched, where = np.unique(flat, return_inverse=True)
            owner = np.repeat(np.arange(len(ids)), sizes)
            g = np.stack([np.bincount(where, gv[owner, k], len(touched)) for k in range(WIDTH)], axis=1).astype(np.float32)
            e_seen[touched] += (g * g).sum(axis=1)
            e[touched] -= np.float32(0.5) * g / np.sqrt(e_seen[touched])[:, None]
    scores = np.append(e @ (w[:, 1] - w[:, 0]), np.float32(0)).astype(np.float32)
    check = np.flatnonzero(kept_out) if len(set(labels[kept_out].tolist())) == 2 else np.arange(len(texts))
    raw = worst([texts[i] for i in check], scores)
    slope, shift = logistic(raw[np.isfinite(raw)], labels[check][np.isfinite(raw)], share)
    return ToxicityModel(scores, slope, shift)


def logistic(x: np.ndarray, y: np.ndarray, share: float, steps: int = 60) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve by Newton steps, with classes weighted to ``share``."""
    if not len(x):
        return 0.0, -30.0
    scale = x.std() or 1.0
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    f = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(f @ b, -30, 30)))
        hess = (f * (weight * p * (1 - p))[:, None]).T @ f + np.diag([0.05, 0.005])
        step = np.linalg.solve(hess, f.T @ (weight * (p - y)) + np.array([0.05, 0.005]) * b)
        b -= np.clip(step, -1, 1)
    slope = max(b[0], 0.0) / scale
    return float(slope), float(b[1] - slope * x.mean())


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", *,
          held_out: Column | None = None, most: int = SAMPLE) -> ToxicityModel:
    """Model of the documents that ``labels`` marks 1, from about ``most`` labelled documents.

    A document with several labels is toxic if one of them says so; null ids and labels and ids
    that ``held_out`` excludes teach nothing. Of an id on several rows one text is taken. Texts
    are learned from whole; the sample has at most ``LETTERS`` characters, drawn by hashed id.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if held_out is not None:
        marks = marks.where(~held_out)
    marks = marks.groupBy(F.col(doc_id).alias("id")).agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("label"))
    keep, counts = chosen(marks, "label", most, F.col("id"))
    sample = broadcast_if_small(materialise(marks.where(keep)))
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL").join(sample, "id")
    # One text of each id, the least by hash: combined in each task, so a repeated id does not pile up.
    sizes = materialise(found.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n"))).alias("t"))
                        .select("id", "label", "t.h", "t.n"))
    so_far = F.sum("n").over(W.orderBy(F.xxhash64("id"), "id").rowsBetween(W.unboundedPreceding, 0))  # about ``most`` rows
    drawn = sizes.withColumn("upto", so_far).where((F.col("upto") <= LETTERS) | (F.col("upto") == F.col("n"))).select("id", "h")
    texts = found.join(broadcast_if_small(materialise(drawn)), "id").where(F.xxhash64("text") == F.col("h"))
    got = texts.groupBy("id").agg(F.max("label").alias("label"), F.min("text").alias("text")).toArrow()
    rows = sorted(zip(got.column("id").to_pylist(), got.column("label").to_pylist(), got.column("text").to_pylist(), strict=True))
    rows = [rows[i] for i in np.random.default_rng(17).permutation(len(rows))]
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return learn([r[2] for r in rows], np.array([r[1] for r in rows], np.int64), share)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", limit: float = LIMIT) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``limit`` on), from each whole text alone.

    A null or blank text has no window and gets the low end of the curve, near 0.
    Repeated rows score alike; other columns pass through, and columns of the two names are
    replaced. An empty table gives an empty result; a model without both classes scores all alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.scores, model.slope, model.shift))  # 2**BITS numbers

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(ToxicityModel(*sent.value).predict([t if isinstance(t, str) else "" for t in texts]))

    return (docs.withColumn("score", rate(F.col(text).cast("string")))
            .withColumn("predicted", (F.col("score") >= limit).cast("int")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every document, by a model that has not seen the fold it is measured on."""
    out = fold_of("doc_id") == 2
    model = train(docs, labels, held_out=out)
    return score_toxicity(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "score", "predicted")
