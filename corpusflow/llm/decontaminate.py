"""Benchmark decontamination on template windows.

Texts become templates: numbers, names (capitalised inside a sentence) and units behind a number
turn into typed placeholders. Windows of template words are hashed and joined with those of the
benchmark; the values that stood in the placeholders come along. One assignment of values must
explain the windows of an item, wherever in the document they stand: an item's value may be
another there, but always the same one. The places of a value vote for what it became; windows
that go against the vote do not count, and without a majority they count against the item. So a
question with other numbers or names is caught, and a chance mixture of its windows is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.sizing import broadcast_if_small

from .common import in_groups, stored
from .subword import alphabet

WINDOW = 6          # template words; if over half are numbers and units, they stand as they are
LEAST = 4           # words of an item that can be told from chance
COVERAGE = 0.5      # share of an item's windows that a document must hold
BITS_PER_HASH = 64  # of the filter in front of the join
MOST_BITS = 1 << 27  # its size never exceeds 16 MB; past that it only lets more windows through
# Words taken for units when a number stands before them.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds "
         "ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours "
         "day days week weeks month months year years percent degree degrees celsius fahrenheit dollar dollars cent "
         "cents euro euros meter meters metre metres centimeter centimeters kilometer kilometers watt watts volt volts "
         "joule joules newton newtons hertz byte bytes").split()
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_P, _Q = 0x100000001B3, 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.append(np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@cache
def _unit_hashes() -> np.ndarray:
    return np.sort(np.array([words(u)[0][0] for u in UNITS], np.uint64))


def words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, whether it is a number, whether it is a name."""
    raw = np.frombuffer(("\n" + text + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    low = alphabet("0123456789")[raw]
    full = low != 0
    start = np.flatnonzero(full[1:] & ~full[:-1]) + 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
    end = np.flatnonzero(full[:-1] & ~full[1:]) + 1
    size = end - start
    letters = low[full].astype(np.uint64)
    first = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        scaled = letters * _powers(_P, int(size.max()))[np.arange(len(letters)) - np.repeat(first, size)]
        h = _mixed(np.add.reduceat(scaled, first) + size.astype(np.uint64))
    digit = (letters >= 48) & (letters <= 57)
    number = np.add.reduceat(digit.astype(np.int64), first) == size
    stops = np.cumsum(np.isin(raw, np.array([ord(c) for c in ".!?:;\n\""], np.uint32)))
    before = np.concatenate([[0], end[:-1]])
    opens = stops[start] - stops[np.maximum(before - 1, 0)] > 0
    opens[0] = True
    second = np.minimum(start + 1, len(raw) - 1)
    name = (raw[start] != low[start]) & (size > 1) & (raw[second] == low[second]) & ~opens
    return h, number, name


def windows(text: str, sizes: list[int], shorter: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Template windows of a text: ``(size, at, hashes, values, slot)``.

    ``at`` are template positions; ``values`` are the words' own hashes and ``slot`` marks the
    words that this reading replaces. A text with names is read twice, once with names replaced
    and once as they stand, so that a change of case hides nothing. Windows mostly of numbers and
    units would match anything as templates; they are read with their own values. With
    ``shorter`` a text under a size is one window of its own length, if that is at least ``LEAST``.
    """
    own, number, name = words(text)
    if not len(own):
        return
    start = np.flatnonzero(~(number & np.concatenate([[False], number[:-1]])))  # 3.5 or 1,000 is one number
    run = np.diff(np.append(start, len(own)))
    with np.errstate(over="ignore"):
        own = np.add.reduceat(own * _powers(_Q, int(run.max()))[np.arange(len(own)) - np.repeat(start, run)], start)
    number, name = number[start], name[start]
    unit = np.zeros(len(own), bool)
    behind = np.flatnonzero(number[:-1]) + 1
    unit[behind] = np.isin(own[behind], _unit_hashes()) & ~number[behind]
    base = np.where(number, _NUMBER, np.where(unit, _UNIT, own))
    counted = number | unit
    none = np.zeros(len(own), bool)
    named, plain = (np.concatenate([[0], np.cumsum(x)]) for x in (name, ~counted))
    free = np.concatenate([[0], np.cumsum(~(counted | name))])
    for size in sizes:
        size = min(size, max(len(own), LEAST)) if shorter else size
        n = len(own) - size + 1
        if n <= 0:
            continue
        heavy = 2 * (plain[size:] - plain[:n]) < size
        with_name = named[size:] > named[:n]
        for mark, slot, ok in ((np.where(name & ~number, _NAME, base), counted | name, 2 * (free[size:] - free[:n]) >= size),
                               (base, counted, with_name & ~heavy), (own, none, heavy)):
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            h = np.full(n, size, np.uint64)
            with np.errstate(over="ignore"):
                for k, q in enumerate(_powers(_Q, size)):
                    h += mark[k:k + n] * q
            yield size, at, _mixed(h[at]), own, slot


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


WINDOW_ROW = "id long, size int, at int, hash long, slots array<long>, offsets array<int>"


def template_windows(rows: DataFrame, sizes: list[int], keep=None, shorter: bool = False) -> DataFrame:
    """All windows of ``rows(id, text)``, or those that the bit filter ``keep`` lets through."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = part.column(0).to_pylist()
            for a, b in in_groups([len(t) for t in texts], 1 << 22):
                out = [[], [], [], [], [], []]
                for i in range(a, b):
                    for size, at, hashes, own, slot in windows(texts[i], sizes, shorter):
                        if keep is not None:
                            bits, mask = keep.value
                            place = hashes & mask
                            hit = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                            at, hashes = at[hit == 1], hashes[hit == 1]
                        for p in at.tolist():
                            inside = np.flatnonzero(slot[p:p + size])
                            out[4].append(_signed(own[p + inside]).tolist())
                            out[5].append(inside.tolist())
                        out[0] += [ids[i]] * len(at)
                        out[1] += [size] * len(at)
                        out[2] += at.tolist()
                        out[3].append(_signed(hashes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                     pa.array(np.concatenate(out[3]) if out[3] else np.zeros(0, np.int64)),
                     pa.array(out[4], pa.list_(pa.int64())), pa.array(out[5], pa.list_(pa.int32()))],
                    ["id", "size", "at", "hash", "slots", "offsets"])

    return rows.mapInArrow(batches, WINDOW_ROW)


def _bit_filter(item_windows: DataFrame):
    """One bit for each window hash of the benchmark, for the tasks that read the documents."""
    n = item_windows.count()
    size = min(1 << max(10, (n * BITS_PER_HASH).bit_length()), MOST_BITS)
    places = item_windows.select(F.col("hash").bitwiseAND(size - 1).alias("p")).groupBy(
        F.shiftright("p", 3).alias("byte")).agg(F.expr("bit_or(shiftleft(1, cast(p % 8 AS int)))").alias("bits"))
    got = places.toArrow()  # at most MOST_BITS / 8 bytes
    bits = np.zeros(size >> 3, np.uint8)
    bits[got.column("byte").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    return item_windows.sparkSession.sparkContext.broadcast((bits, np.uint64(size - 1)))


def _bindings(found: DataFrame) -> DataFrame:
    """What became of each value of an item in a document: ``(id, item_id, bound)``.

    The value that stands at most of its places; ties go to the item's own value, then to that of
    more windows, then to the least. ``null`` if that is a changed value at half of the places or
    fewer. A row holds as many values as the item has.
    """
    seen = found.select("id", "item_id", F.explode("pairs").alias("p")).select("id", "item_id", "p.*")
    seen = seen.groupBy("id", "item_id", "was", "now", "place").agg(F.count(F.lit(1)).alias("n"))
    votes = seen.groupBy("id", "item_id", "was", "now").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("n"))
    places = seen.groupBy(F.col("id").alias("_id"), F.col("item_id").alias("_item"), F.col("was").alias("_was")).agg(
        F.countDistinct("place").alias("every"))
    best = votes.groupBy("id", "item_id", "was").agg(F.max(F.struct(
        "places", (F.col("was") == F.col("now")).alias("own"), "n", (-F.col("now")).alias("least"), "now")).alias("best"))
    same = F.col("id").eqNullSafe(F.col("_id")) & F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("was") == F.col("_was"))
    told = best.join(places, same).select(
        "id", "item_id", "was", F.when(F.col("best.own") | (2 * F.col("best.places") > F.col("every")), F.col("best.now")).alias("now"))
    return told.groupBy("id", "item_id").agg(F.map_from_entries(F.collect_list(F.struct("was", "now"))).alias("bound"))


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """Documents that hold a benchmark item: one row for each document and item.

    ``n_windows`` are the item's windows, ``n_matched`` those found in the document with the values
    that won the vote, ``n_against`` those found only with a value that has no majority, ``share``
    the part of the item's windows by which the first exceed the second (at least ``coverage``),
    ``first_word`` the least template position of a match, ``reparameterised`` tells that a value
    was changed.

    Items of fewer than ``window`` words are one window of their own length; items under ``LEAST``
    words (a number of several parts is one word), empty or null match nothing. Null and empty
    documents match nothing. Repeated rows of a document count once; documents without an id share
    one null id. Other columns are not read; empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    item_windows = stored(template_windows(items, [window], shorter=True), "item-windows")
    sizes = sorted(r[0] for r in item_windows.select("size").distinct().collect()) or [window]  # up to ``window``
    found = template_windows(rows, sizes, _bit_filter(item_windows)).drop("offsets")
    total = item_windows.groupBy(F.col("id").alias("_id")).agg(F.countDistinct("at").alias("n_windows"))
    keys = item_windows.join(total, F.col("id").eqNullSafe(F.col("_id"))).select(
        F.col("id").alias("item_id"), F.col("at").alias("item_at"), "size", "hash", F.col("slots").alias("item_slots"), "offsets", "n_windows")
    met = found.join(broadcast_if_small(keys, "96"), ["size", "hash"])
    pairs = F.transform(F.arrays_zip("item_slots", "slots", "offsets"), lambda x: F.struct(
        x["item_slots"].alias("was"), x["slots"].alias("now"), (F.col("item_at") + x["offsets"]).alias("place")))
    met = stored(met.groupBy("id", "item_id", "n_windows", "item_at", pairs.alias("pairs")).agg(F.min("at").alias("first")), "met")
    bound = _bindings(met).withColumnsRenamed({"id": "_id", "item_id": "_item"})
    mine = F.col("id").eqNullSafe(F.col("_id")) & F.col("item_id").eqNullSafe(F.col("_item"))
    told = met.join(bound, mine, "left").select(
        "id", "item_id", "n_windows", "item_at", "first",
        F.forall("pairs", lambda x: F.coalesce(F.col("bound")[x["was"]] == x["now"], F.lit(False))).alias("follows"),
        F.exists("pairs", lambda x: F.col("bound")[x["was"]].isNull()).alias("open"),
        F.exists("pairs", lambda x: x["was"] != x["now"]).alias("changed"))
    places = told.groupBy("id", "item_id", "n_windows", "item_at").agg(
        F.bool_or("follows").alias("follows"), F.bool_or("open").alias("open"),
        F.min(F.when(F.col("follows"), F.col("first"))).alias("first"), F.bool_or(F.col("follows") & F.col("changed")).alias("changed"))
    out = places.groupBy("id", "item_id", "n_windows").agg(
        F.count_if("follows").alias("n_matched"), F.count_if(~F.col("follows") & F.col("open")).alias("n_against"),
        F.min("first").cast("long").alias("first_word"), F.bool_or("changed").alias("reparameterised"))
    share = (F.col("n_matched") - F.col("n_against")) / F.col("n_windows")
    return out.where(share >= coverage).select(
        F.col("id").alias("doc_id"), "item_id", "n_windows", "n_matched", "n_against", share.alias("share"), "first_word", "reparameterised")
