"""Hashed character n-grams of words as numpy arrays, and bounded labelled samples to learn from."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import uniform

PIECE = 1 << 20  # code points handled at once; longer texts are cut at the last word end before


@cache
def alphabet(extra: str = "") -> np.ndarray:
    """Of each code point its lower-case form if it is a letter or in ``extra``, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        ch = chr(i)
        if ch.isalpha():
            low = ch.lower()
            out[i] = ord(low) if len(low) == 1 else i
    for ch in extra:
        out[ord(ch)] = ord(ch)
    return out


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Code points of a text under the alphabet, 0 for all that is no part of a word."""
    return table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def pieces(texts: list[str], table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(codes, owners, starts)``: spans of texts behind one another, each led by a 0.

    Short texts share a piece; a text over the piece size gives several spans of its own, cut
    between words. ``owners`` are indexes of texts, ``starts`` where each span begins.
    """
    held, owners, starts, size = [], [], [], 0
    gap = np.zeros(1, np.uint32)
    for i, text in enumerate(texts):
        codes, at = letters(text, table), 0
        while at < len(codes) or at == 0:
            end = min(at + PIECE, len(codes))
            if end < len(codes):
                blank = np.flatnonzero(codes[at:end] == 0)
                end = at + int(blank[-1]) + 1 if len(blank) else end
            if size and size + end - at > PIECE:
                yield np.concatenate([*held, gap]), np.array(owners), np.array(starts)
                held, owners, starts, size = [], [], [], 0
            held += [gap, codes[at:end]]
            owners.append(i)
            starts.append(size)
            size += end - at + 1
            at = max(end, 1)
    if held:
        yield np.concatenate([*held, gap]), np.array(owners), np.array(starts)


def grams(codes: np.ndarray, least: int, most: int, bits: int) -> Iterator[np.ndarray]:
    """For each length a bucket for the n-gram at each place, ``2**bits`` where there is none.

    An n-gram holds letters of one word and may hold the gap on either side of it.
    """
    full = codes != 0
    h = np.zeros(len(codes), np.uint32)
    inner = np.ones(len(codes), bool)
    with np.errstate(over="ignore"):
        for n in range(1, most + 1):
            m = len(codes) - n + 1
            if m <= 0:
                return
            h = h[:m] * np.uint32(0x01000193) + codes[n - 1:]
            if n >= 3:
                inner = inner[:m] & full[n - 2:n - 2 + m]
                there = inner
            else:
                there = full[:m] if n == 1 else full[:m] | full[1:1 + m]
            if n >= least:
                x = (h ^ (h >> np.uint32(15)) ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
                at = (x >> np.uint32(32 - bits)).astype(np.int32)
                at[~there] = 1 << bits
                yield at


def chosen(rows: DataFrame, label: str, most: int, *key: Column, max_classes: int = 1000) -> tuple[Column, dict]:
    """Condition that keeps about ``most`` labelled rows, as even over the classes as they allow.

    Whether a row is kept depends on its ``key`` and its class's share alone, so rows of one key
    are kept or left together: a key tells texts apart, not ids alone. The counts of the classes,
    one small combined aggregate, are the only thing that comes to the driver. A model has at
    most ``max_classes`` classes, the most frequent ones.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_classes).collect()
              if r[0] is not None}
    if not counts:
        return F.lit(False), counts
    share, left, todo = {}, most, len(counts)
    for name, n in sorted(counts.items(), key=lambda x: x[1]):
        share[name] = min(1.0, left / todo / n)
        left, todo = left - min(n, left / todo), todo - 1
    rate = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    return uniform(F.lit("sample"), *key) < F.coalesce(F.try_element_at(rate, F.col(label)), F.lit(0.0)), counts
