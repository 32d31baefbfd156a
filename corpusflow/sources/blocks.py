"""Records of CSV and JSON files of any size, each file read by many tasks.

A file is cut into pieces (lines, or what stands between commas) by Spark's text source, which
splits it at byte ranges: the blocks. Whether a line break or a comma ends a record depends on what
stands before it in the file, which a block does not know. So a first pass says for each block
what it does to the state it is entered with: whether it flips "inside quotes", and, for either
case, how many records begin in it (CSV) or how far it changes the depth and how many commas it
has at each depth (JSON). Sums over the blocks before then give each block its state and the number
of its first record, and a second pass cuts the records. Only the ends of a record that runs over a
block border are brought together by a shuffle; nothing else is stored or moved.

Both passes read through a session whose split settings are fixed, so they see the same blocks,
whatever cores are at hand.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sizing import fits_broadcast

QUOTE, SLASH, COMMA = b'"'[0], b"\\"[0], b","[0]
RECORD = "_path string, _block bigint, record_no bigint, whole boolean, record string, decoded boolean"
Reader = Callable[[SparkSession], DataFrame]


def _pinned(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which the cut of files does not depend on cores that come and go."""
    out = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            out.conf.set(key, value)
    out.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return out


def _by_block(batches: Iterator[pa.RecordBatch], begin, add, end) -> Iterator:
    """Feed a task's rows to one state per block; a block's rows follow each other, over batches."""
    state, at = None, None
    for batch in batches:
        paths, blocks, values = batch.column("_path"), batch.column("_block").to_numpy(), batch.column("value")
        changes = np.flatnonzero((np.diff(blocks) != 0) | np.not_equal(*(paths.dictionary_encode().indices.to_numpy()[s] for s in (slice(1, None), slice(None, -1))))) + 1
        for a, b in zip([0, *changes.tolist()], [*changes.tolist(), len(blocks)], strict=True):
            if a == b:
                continue
            here = (paths[a].as_py(), int(blocks[a]))
            if here != at:
                if at is not None:
                    yield from end(at, state)
                state, at = begin(batch, a), here
            yield from add(at, state, values.slice(a, b - a).to_pylist())
    if at is not None:
        yield from end(at, state)


def _sent(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows of blocks with the state that each block is entered with, still in the order of the file."""
    if fits_broadcast(blocks, "length(_path) + 64"):
        return rows.join(F.broadcast(blocks), ["_path", "_block"])
    ordered = rows.withColumn("_order", F.monotonically_increasing_id()).join(blocks, ["_path", "_block"])
    return ordered.repartition("_path", "_block").sortWithinPartitions("_path", "_block", "_order").drop("_order")


def _records(parts: DataFrame, glue: str) -> DataFrame:
    """``(_path, record_no, record, decoded)``, with the parts of records that cross blocks put together."""
    ends = parts.where(~F.col("whole")).groupBy("_path", "record_no").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_block", "record")))["record"], glue).alias("record"),
        F.bool_and("decoded").alias("decoded"))
    return parts.where("whole").select("_path", "record_no", "record", "decoded").unionByName(ends)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["_path", "_block", "record_no", "whole", "record", "decoded"])


def _text(value: bytes) -> tuple[str, bool]:
    try:
        return value.decode(), True
    except UnicodeDecodeError:
        return value.decode(errors="replace"), False


# --- CSV -------------------------------------------------------------------------------------

def csv_records(spark: SparkSession, lines: Reader, quoted: bool = True) -> DataFrame:
    """``(_path, record_no, record, decoded)``: records by RFC 4180, numbered from 0; blank lines are none.

    ``lines(session)`` reads ``(value, _path, _block)``, line by line. Without ``quoted`` every
    line is a record.
    """
    rows = lines(_pinned(spark)).select(F.col("value").cast("binary").alias("value"), "_path", "_block")
    count = (lambda line: line.count(b'"') & 1) if quoted else lambda line: 0

    def summary(batches):
        def add(at, state, values):
            for line in values:
                if line.rstrip(b"\r"):
                    state[1 + state[0]] += 1  # begins a record if the block is entered with this parity
                state[0] ^= count(line)
            yield from ()

        for (path, block), (odd, even, other) in _by_block(batches, lambda *_: [0, 0, 0], add, lambda at, state: [(at, tuple(state))]):
            yield pa.RecordBatch.from_arrays([pa.array([path]), *(pa.array([x], pa.int64()) for x in (block, odd, even, other))],
                                             ["_path", "_block", "odd", "starts0", "starts1"])

    blocks = rows.mapInArrow(summary, "_path string, _block bigint, odd bigint, starts0 bigint, starts1 bigint")
    before = W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 1, F.col("starts1")).otherwise(F.col("starts0"))
    blocks = blocks.withColumn("begun", begun).select("_path", "_block", "inside", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("first"))

    def cut(batches):
        def begin(batch, row):
            inside = batch.column("inside")[row].as_py()
            return {"inside": inside, "next": batch.column("first")[row].as_py(), "held": [], "head": bool(inside)}

        def add(at, state, values):
            out = []
            for line in values:
                if not state["inside"] and not line.rstrip(b"\r"):
                    continue
                state["held"].append(line)
                state["inside"] ^= count(line)
                if not state["inside"]:
                    out.append((*at, *taken(state)))
            yield _batch(out)

        def taken(state, whole=True):
            record, good = _text(b"\n".join(state["held"]))
            number = state["next"] - state["head"]  # a record that was open at the border has its number already
            state["next"] += not state["head"]
            whole, state["head"], state["held"] = whole and not state["head"], False, []
            return number, whole, record.removesuffix("\r") if whole else record, good

        def end(at, state):
            yield _batch([(*at, *taken(state, False))] if state["held"] else [])

        yield from _by_block(batches, begin, add, end)

    return _records(_sent(rows, blocks).mapInArrow(cut, RECORD), "\n")


def _parsed(record: str) -> list[str]:
    return next(csv.reader(io.StringIO(record.removesuffix("\r"), newline="")), [])


@F.arrow_udf(T.ArrayType(T.StringType()))
def csv_fields(records: pa.Array) -> pa.Array:
    """Fields of a record; null if a quote stays open."""
    csv.field_size_limit(sys.maxsize)
    return pa.array([None if r is None or r.count('"') % 2 else _parsed(r) for r in records.to_pylist()], pa.list_(pa.string()))


def header_names(fields: list[str]) -> list[str]:
    """Column names of a header; nameless columns and repeated names get their place."""
    names: list[str] = []
    for i, name in enumerate(fields):
        name = name.lstrip("﻿") if i == 0 else name
        taken = {n.lower() for n in names}
        names.append(f"{name}{i}" if name.lower() in taken else name or f"_c{i}")
    return names


@F.arrow_udf(T.ArrayType(T.StringType()))
def csv_header(records: pa.Array) -> pa.Array:
    return pa.array([None if r is None else [n.strip() for n in header_names(_parsed(r))] for r in records.to_pylist()], pa.list_(pa.string()))


# --- JSON ------------------------------------------------------------------------------------

def _run(data: bytes, k: int) -> int:
    """Backslashes right before a place."""
    n = 0
    while k - n > 0 and data[k - n - 1] == SLASH:
        n += 1
    return n


class _Scan:
    """Depth and string state through the bytes of a block, entered outside (0) or inside (1) a string."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth

    def commas(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the commas outside strings, the depth of each, and the depths that brackets close to."""
        raw = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(raw == QUOTE)
        escaped = quotes[(quotes > 0) & (raw[quotes - 1] == SLASH)]
        if len(escaped):  # an odd run of backslashes in front
            odd = [_run(data, k) % 2 for k in escaped.tolist()]
            quotes = np.setdiff1d(quotes, escaped[np.array(odd, bool)], assume_unique=True)
        marks = np.flatnonzero((raw == COMMA) | np.isin(raw, np.frombuffer(b"[]{}", np.uint8)))
        marks = marks[(np.searchsorted(quotes, marks) + self.inside) % 2 == 0]
        kind = raw[marks]
        step = np.isin(kind, np.frombuffer(b"[{", np.uint8)).astype(np.int64) - np.isin(kind, np.frombuffer(b"]}", np.uint8))
        depth = self.depth + np.cumsum(step)
        self.depth, self.inside = int(depth[-1]) if len(depth) else self.depth, (self.inside + len(quotes)) % 2
        return marks[kind == COMMA], depth[kind == COMMA], depth[step < 0]


def json_elements(spark: SparkSession, pieces: Reader) -> tuple[DataFrame, DataFrame]:
    """Elements of top-level arrays and members of top-level objects, and what each file is.

    ``pieces(session)`` reads ``(value, _path, _block)``, comma by comma. The first table is
    ``(_path, record_no, record, decoded)``, numbered from 0, brackets at both ends of a file
    still in place; the second ``(_path, opens, elements, depth, inside, values)``: first sign, number of
    elements, depth and string state at the end (zero for a whole file), and how many arrays or
    objects end at the top (one, but for files of JSON lines).
    """
    rows = pieces(_pinned(spark)).select(F.col("value").cast("binary").alias("value"), "_path", "_block")

    def summary(batches):
        def add(at, state, values):
            data = b",".join(values) + b","
            if not state["opens"]:
                state["opens"] = data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
            for k, scan in enumerate(state["scans"]):
                for held, depths in zip((state["commas"][k], state["closes"][k]), scan.commas(data)[1:], strict=True):
                    for depth, m in zip(*(x.tolist() for x in np.unique(depths, return_counts=True)), strict=True):
                        held[depth] = held.get(depth, 0) + m
            yield from ()

        begin = lambda *_: {"opens": b"", "scans": (_Scan(0, 0), _Scan(1, 0)), "commas": ({}, {}), "closes": ({}, {})}
        for (path, block), state in _by_block(batches, begin, add, lambda at, state: [(at, state)]):
            a, b = state["scans"]
            counts = [pa.array([list(c.items())], pa.map_(pa.int64(), pa.int64())) for c in (*state["commas"], *state["closes"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([block], pa.int64()), pa.array([state["opens"].decode(errors="replace") or None], pa.string()),
                 *(pa.array([x], pa.int64()) for x in (a.inside, a.depth, b.depth)), *counts],
                ["_path", "_block", "opens", "odd", "depth0", "depth1", "commas0", "commas1", "closes0", "closes1"])

    blocks = rows.mapInArrow(summary, "_path string, _block bigint, opens string, odd bigint, depth0 bigint, depth1 bigint, "
                                      "commas0 map<bigint,bigint>, commas1 map<bigint,bigint>, closes0 map<bigint,bigint>, closes1 map<bigint,bigint>")
    before = W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    either = lambda c: F.when(F.col("inside") == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    blocks = blocks.withColumn("inside", upto("odd") % 2).withColumn("change", either("depth")).withColumn("entry", upto("change"))
    at_depth = lambda counts, depth: F.coalesce(F.try_element_at(either(counts), depth - F.col("entry")), F.lit(0))
    blocks = blocks.withColumn("borders", at_depth("commas", 1)).withColumn("ends", at_depth("closes", 0)).withColumn("first", upto("borders"))
    files = blocks.groupBy("_path").agg(
        F.min_by("opens", F.when(F.col("opens").isNotNull(), F.col("_block"))).alias("opens"), (F.sum("borders") + 1).alias("elements"),
        F.sum("change").alias("depth"), (F.sum("odd") % 2).alias("inside"), F.sum("ends").alias("values"))

    def cut(batches):
        def begin(batch, row):
            get = lambda c: batch.column(c)[row].as_py()
            return {"scan": _Scan(get("inside"), get("entry")), "next": get("first"), "held": [], "head": True}

        def add(at, state, values):
            data, out, start = b",".join(values) + b",", [], 0
            places, depth, _ = state["scan"].commas(data)
            for place in places[depth == 1].tolist():
                out.append(taken(at, state, [*state["held"], data[start:place]]))
                state["held"], start = [], place + 1
            state["held"].append(data[start:])
            yield _batch(out)

        def taken(at, state, held, last=False):
            record, good = _text(b"".join(held))
            whole, state["head"], state["next"] = not last and not state["head"], False, state["next"] + 1
            return *at, state["next"] - 1, whole, record, good

        yield from _by_block(batches, begin, add, lambda at, state: [_batch([taken(at, state, state["held"], True)])])

    parts = _sent(rows, blocks.select("_path", "_block", "inside", "entry", "first")).mapInArrow(cut, RECORD)
    return _records(parts, ""), files
