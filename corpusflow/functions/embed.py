"""Text embedding by signed feature hashing (Weinberger et al. 2009).

The JVM turns a text into its *signature*: one signed bucket number per token. An Arrow function
adds a batch of signatures up to unit vectors. An embedder is any ``Column -> Column`` function
from text to ``ARRAY<FLOAT>``, so a model-backed Arrow function can take the place of ``embed``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, tokens

DIM = 384


def signature(text, dim: int = DIM) -> Column:
    """``ARRAY<INT>``: +-(bucket + 1) for each token, from the first 8 digits of its md5."""
    digests = F.transform(tokens(text), lambda t: F.md5(t))
    return F.transform(digests, lambda h: (
        (F.conv(F.substring(h, 1, 7), 16, 10).cast("int") % F.lit(dim) + F.lit(1))
        * F.when(F.substring(h, 8, 1) < F.lit("8"), F.lit(1)).otherwise(F.lit(-1))))


def expand(codes: np.ndarray, starts: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors, one per run of signed bucket codes. A run without tokens gives zeros."""
    rows = len(starts) - 1
    owner = np.repeat(np.arange(rows), np.diff(starts))
    flat = owner * dim + np.abs(codes).astype(np.int64) - 1
    sums = np.bincount(flat, weights=np.sign(codes), minlength=rows * dim).reshape(rows, dim)
    length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
    length[length == 0.0] = 1.0
    return sums / length[:, None]


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and zero-based run starts of a list column; null lists count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), starts


def embedder(dim: int = DIM):
    """Arrow function from a signature to ``ARRAY<FLOAT>``."""

    @F.arrow_udf("array<float>")
    def vectors(codes: pa.Array) -> pa.Array:
        values, starts = list_parts(codes)
        matrix = expand(values, starts, dim).astype(np.float32)
        ends = np.arange(len(starts)) * dim
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(matrix.ravel()))

    return vectors


def embed(text, dim: int = DIM, prompt: str = "") -> Column:
    """Unit vector of a text; a query prompt, when given, goes in front of it."""
    full = F.concat(F.lit(prompt), _col(text)) if prompt else _col(text)
    return embedder(dim)(signature(full, dim))


def _nested(column: pa.Array):
    """Sentence runs of a list-of-lists column: codes, starts per sentence, starts per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    codes, starts = list_parts(column.flatten())
    return codes, starts, rows


# Sentences expanded to dense vectors at a time inside one task: bounds task memory.
TILE = 2048


def _tiles(starts: np.ndarray, codes: np.ndarray, dim: int, overlap: int = 0):
    """Dense vectors of consecutive sentences in bounded tiles; ``overlap`` repeats the last."""
    total = len(starts) - 1
    at = 0
    while at < total:
        end = min(at + TILE, total)
        first = max(at - overlap, 0)
        window = starts[first:end + 1]
        yield first, end, expand(codes[window[0]:window[-1]], window - window[0], dim)
        at = end


def _breaks(gaps: np.ndarray, percentile: float) -> np.ndarray:
    """Positions after which a gap exceeds the percentile of all gaps (linear interpolation)."""
    if not len(gaps):
        return np.empty(0, np.int64)
    ordered = np.sort(gaps)
    place = (len(gaps) - 1) * (percentile / 100.0)
    low = int(place)
    high = min(low + 1, len(gaps) - 1)
    limit = ordered[low] + (ordered[high] - ordered[low]) * (place - low)
    return np.flatnonzero(gaps > limit)


def semantic_starts(percentile: float = 90.0, dim: int = DIM):
    """Arrow function: per row, the 0-based sentences at which a semantic chunk starts.

    The gap of two neighbouring sentences is 1 - cosine of their vectors. A sentence without
    tokens has no direction and is at distance 1 from its neighbours.
    """

    @F.arrow_udf("array<int>")
    def starts_of(signatures: pa.Array) -> pa.Array:
        codes, starts, rows = _nested(signatures)
        gap = np.ones(len(starts) - 1)
        for first, end, dense in _tiles(starts, codes, dim, overlap=1):
            if end - first > 1:
                gap[first + 1:end] = 1.0 - np.einsum("ij,ij->i", dense[1:], dense[:-1])
        gap = np.round(gap, 6) + 0.0
        out = []
        for a, b in zip(rows[:-1], rows[1:]):
            first = np.zeros(1 if b > a else 0, np.int64)
            out.append(np.concatenate([first, _breaks(gap[a + 1:b], percentile) + 1]).astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    return starts_of


def sentence_scores(dim: int = DIM):
    """Arrow function: cosine of a query signature to each sentence signature of the row."""

    @F.arrow_udf("array<double>")
    def scores(query: pa.Array, signatures: pa.Array) -> pa.Array:
        q_codes, q_starts = list_parts(query)
        queries = expand(q_codes, q_starts, dim)
        codes, starts, rows = _nested(signatures)
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        out = np.zeros(len(starts) - 1)
        for first, end, dense in _tiles(starts, codes, dim):
            out[first:end] = np.einsum("ij,ij->i", dense, queries[owner[first:end]])
        out = np.round(out, 6) + 0.0
        return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(out))

    return scores
