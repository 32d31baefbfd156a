"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the vectors of its hashed character n-grams. Vectors and softmax are
learned together by stochastic gradient descent in numpy on a bounded sample. There is no bias
and unseen buckets hold the zero vector, so text without learned n-grams scores all languages
alike. A temperature fitted on rows kept out of the descent turns scores into calibrated
probabilities; a document whose best language is less likely than ``LEAST`` is rejected, being
more likely wrong than right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_of, fresh
from .subword import alphabet, chosen, grams, pieces

ORDERS = (1, 4)     # lengths of n-grams
BITS = 18           # log2 of the number of buckets, many more than a sample fills
WIDTH = 16          # of a vector
SAMPLE = 2000       # labelled rows that the model learns from, at most
LEAST = 0.5         # calibrated probability under which a document is rejected
UNKNOWN = "und"


@dataclass
class LanguageModel:
    names: list[str]
    scores: np.ndarray  # of each bucket for each language, with a zero row for "no n-gram"
    sharpness: float    # inverse temperature

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability of each text."""
        texts = [t or "" for t in texts]
        sums = np.zeros((len(texts), len(self.names)))
        seen, letter = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for codes, owners, starts in pieces(texts, alphabet()):
            np.logical_or.at(letter, owners, np.add.reduceat((codes != 0).astype(np.int64), starts) > 0)
            for at in grams(codes, *ORDERS, BITS):
                ok = starts < len(at)
                np.add.at(seen, owners[ok], np.add.reduceat((at < 1 << BITS).astype(np.float64), starts[ok]))
                for k in range(len(self.names)):
                    np.add.at(sums[:, k], owners[ok], np.add.reduceat(self.scores[k][at], starts[ok], dtype=np.float64))
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.sharpness * sums / np.maximum(seen, 1)[:, None])
        best = p.argmax(axis=1)
        return ([self.names[b] if ok else UNKNOWN for b, ok in zip(best, letter, strict=True)],
                np.where(letter, p[np.arange(len(p)), best], 0.0))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bag(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text with their shares in it."""
    found: dict[int, list[np.ndarray]] = {}
    for codes, owners, starts in pieces(texts, alphabet()):
        ends = [*starts[1:].tolist(), len(codes)]
        for at in grams(codes, *ORDERS, BITS):
            for i, a, b in zip(owners.tolist(), starts.tolist(), ends, strict=True):
                found.setdefault(i, []).append(at[a:b][at[a:b] < 1 << BITS])
    for i in range(len(texts)):
        at, n = np.unique(np.concatenate(found[i]) if i in found else np.zeros(0, np.int32), return_counts=True)
        yield at.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)


def learn(labels: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], names: list[str], epochs: int = 30,
          seed: int = 11) -> LanguageModel:
    """Joint gradient descent on vectors and softmax; every fourth row only sets the temperature."""
    rng = np.random.default_rng(seed)
    n, kinds = len(bags), len(names)
    e = np.zeros((1 << BITS, WIDTH), np.float32)
    w = rng.normal(0, 1, (WIDTH, kinds)).astype(np.float32)
    kept_out = np.arange(n) % 4 == 3 if n >= 8 * kinds else np.zeros(n, bool)
    rows = np.flatnonzero(~kept_out)
    weight = (len(rows) / (kinds * np.bincount(labels[rows], minlength=kinds).clip(1))).astype(np.float32)
    for epoch in range(epochs):
        rate = 20.0 * (1 - epoch / epochs) + 0.5
        order = rng.permutation(rows)
        for a in range(0, len(order), 64):
            at = order[a:a + 64]
            used, where = np.unique(np.concatenate([bags[i][0] for i in at]), return_inverse=True)
            xb = np.zeros((len(at), len(used)), np.float32)  # the buckets of this batch alone
            xb[np.repeat(np.arange(len(at)), [len(bags[i][0]) for i in at]), where] = np.concatenate([bags[i][1] for i in at])
            h = xb @ e[used]
            g = softmax(h @ w)
            g[np.arange(len(at)), labels[at]] -= 1
            g *= (weight[labels[at]] / len(at))[:, None]
            back = g @ w.T
            w -= np.float32(0.02 * rate) * (h.T @ g)
            e[used] -= np.float32(rate) * (xb.T @ back)
    scores = np.concatenate([e @ w, np.zeros((1, kinds), np.float32)]).astype(np.float32)
    check = np.flatnonzero(kept_out) if kept_out.any() else rows
    z = np.array([share @ scores[at] for at, share in (bags[i] for i in check)]).reshape(-1, kinds)

    def loss(t: float) -> float:
        p = softmax(t * z)[np.arange(len(check)), labels[check]]
        return -(np.log(np.maximum(p, 1e-12)) * weight[labels[check]]).mean() + 1e-4 * t

    sharpness = min(np.geomspace(0.05, 20, 60), key=loss) if len(check) else 1.0
    return LanguageModel(names, scores.T.copy(), float(sharpness))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", *,
          held_out: Column | None = None, most: int = SAMPLE) -> LanguageModel:
    """Model of the languages named in ``label``, from about ``most`` rows, even over languages.

    Rows where ``held_out`` is true, or without text or label, teach nothing. Rows are drawn by id
    and text, and rows that share both are one. The n-grams of the sample are counted in tasks
    over whole texts; a row comes back as its buckets and their shares.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    if held_out is not None:
        rows = rows.where(~held_out)
    rows = rows.select(F.col(doc_id).alias("id"), F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keep, counts = chosen(rows.select("label"), "label", most, F.col("id"), F.col("h"))
    if not counts:
        return LanguageModel([], np.zeros((0, (1 << BITS) + 1), np.float32), 1.0)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at, share = zip(*bag(part.column(1).to_pylist()), strict=True) if part.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(list(at), pa.list_(pa.int32())), pa.array(list(share), pa.list_(pa.float32()))],
                ["label", "at", "share"])

    drawn = rows.where(keep).groupBy("id", "h", "label").agg(F.min("text").alias("text"))
    got = drawn.select("label", "text").mapInArrow(count, "label string, at array<int>, share array<float>").toArrow()
    names = sorted(counts)
    bags = [(at.values.to_numpy(), share.values.to_numpy()) for at, share in zip(got.column("at"), got.column("share"), strict=True)]
    labels = [names.index(x) for x in got.column("label").to_pylist()]
    # A fixed order, whatever the order in which tasks end.
    order = sorted(range(len(labels)), key=lambda i: (labels[i], len(bags[i][0]), bags[i][0].tobytes(), bags[i][1].tobytes()))
    order = [order[i] for i in np.random.default_rng(5).permutation(len(order))][:2 * most]
    return learn(np.array([labels[i] for i in order], np.int64), [bags[i] for i in order], names)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``, from the whole text of each row alone.

    A null text or one without a letter gives ``und``, score 0, rejected. Ties go to the first
    language by name. Repeated rows are scored alike, other columns pass through; columns that
    already have one of the three names are replaced. An empty table gives an empty result; a
    model learned from no rows rejects everything.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.scores, model.sharpness))  # 2**BITS numbers a language

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        names, scores, sharpness = sent.value
        lang, score = LanguageModel(names, scores, sharpness).predict([t if isinstance(t, str) else "" for t in texts])
        return pd.DataFrame({"lang": lang, "score": score})

    guessed, = fresh(docs, "guess")
    out = docs.withColumn(guessed, guess(F.col(text).cast("string")))
    out = out.withColumns({"lang_pred": F.col(f"{guessed}.lang"), "score": F.col(f"{guessed}.score")})
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).drop(guessed)


def languages(docs: DataFrame) -> DataFrame:
    """Language of every document, by a model that has not seen the fold it is measured on."""
    model = train(docs, held_out=fold_of("doc_id") == 2)
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold_of("doc_id") == 2).alias("held_out"), "lang_pred", "score", "rejected")
