"""Splitters: documents table in, chunks table out. Every splitter is one narrow pass."""

from __future__ import annotations

from collections import deque
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embed import DIM, semantic_starts, signature
from ..functions.text import sentences
from ..plans.ranking import explode_list
from ..plans.sizing import in_groups

# Separators from coarse to fine.
AT_ONCE = 1 << 20  # bytes of texts held as Python strings at a time inside one task
PLAIN = ("\n\n", "\n", " ", "")
PYTHON = ("\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ", "")


def _pieces(text: str, separator: str) -> list[str]:
    """Cut in front of each separator, so that joining the pieces gives the text back."""
    head, *tail = text.split(separator)
    return ([head] if head else []) + [separator + t for t in tail]


def _windows(text: str, size: int, overlap: int) -> list[str]:
    """Character windows: what packing single characters comes to."""
    last = max(len(text) - overlap, 1)
    return [text[at:at + size] for at in range(0, last, size - overlap)]


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Join pieces up to ``size``; start the next chunk with up to ``overlap`` trailing chars."""
    out, held, length = [], deque(), 0
    for piece in pieces:
        if held and length + len(piece) > size:
            out.append("".join(held))
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    if held:
        out.append("".join(held))
    return out


def split_text(text: str, size: int, overlap: int, separators=PLAIN) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that serves."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text or i == len(separators) - 1)
    separator, finer = separators[at], separators[at + 1:]
    if separator == "":
        found = _windows(text, size, overlap)
    else:
        found, run = [], []
        for piece in _pieces(text, separator):
            if len(piece) <= size or not finer:
                run.append(piece)
                continue
            found += _pack(run, size, overlap)
            run = []
            found += split_text(piece, size, overlap, finer)
        found += _pack(run, size, overlap)
    return [chunk for chunk in (c.strip() for c in found) if chunk]


def _chunk_lists(texts: pa.Array, size: int, overlap: int, separators) -> pa.Array:
    """Chunks of each text, a bounded run of texts at a time."""
    kind = pa.list_(pa.string())
    done = [pa.array([None if t is None else split_text(t, size, overlap, separators) for t in texts.slice(a, b - a).to_pylist()], kind)
            for a, b in in_groups(pc.binary_length(texts).fill_null(0).to_pylist(), AT_ONCE)]
    return pa.concat_arrays(done) if done else pa.array([], kind)


def recursive(text, size: int = 300, overlap: int = 30, separators=PLAIN) -> Column:
    """``ARRAY<STRING>`` of chunks; null stays null."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")

    @F.arrow_udf("array<string>")
    def chunks(texts: pa.Array) -> pa.Array:
        return _chunk_lists(texts, size, overlap, separators)

    return chunks(text)


def semantic_parts(docs: DataFrame, text: str = "text", percentile: float = 90.0,
                   dim: int = DIM) -> DataFrame:
    """Add ``semantic ARRAY<STRING>`` and ``has_empty_sentence``.

    A cut falls where the distance of two neighbouring sentences exceeds the document's own
    percentile (linear interpolation). Tokens, hashes and joining are expressions on the
    document's own arrays and only the cuts come from Arrow, so nothing is shuffled.
    """
    base = docs.withColumn("_sent", sentences(text))
    base = base.withColumn("_codes", F.transform("_sent", lambda s: signature(s, dim)))
    base = base.withColumn("_starts", semantic_starts(percentile, dim)(F.col("_codes")))
    parts = F.transform("_starts", lambda s, j: F.array_join(F.slice(F.col("_sent"), s + 1, F.coalesce(
        F.get("_starts", j + 1), F.size("_sent")) - s), " "))
    return (base.withColumn("has_empty_sentence", F.exists("_codes", lambda c: F.size(c) == 0))
            .withColumn("semantic", parts).drop("_sent", "_codes", "_starts"))


def smart_parts(docs: DataFrame, text: str = "text", max_size: int = 1000, fallback_size: int = 500,
                fallback_overlap: int = 50, percentile: float = 90.0, dim: int = DIM) -> DataFrame:
    """Add ``smart ARRAY<STRING>`` and ``used_fallback``.

    Semantic chunks, unless one is longer than ``max_size`` or a sentence has no vector: then the
    whole document is split recursively. The splitter sees only the documents that need it.
    """
    parts = semantic_parts(docs, text, percentile, dim)
    oversize = F.exists("semantic", lambda c: F.length(c) > max_size)
    parts = parts.withColumn("used_fallback", oversize | F.col("has_empty_sentence"))
    needed = F.when(F.col("used_fallback"), F.col(text))
    parts = parts.withColumn("_fallback", recursive(needed, fallback_size, fallback_overlap))
    return (parts.withColumn("smart", F.when(F.col("used_fallback"), F.col("_fallback"))
                             .otherwise(F.col("semantic")))
            .drop("_fallback", "semantic", "has_empty_sentence"))


def explode_chunks(docs: DataFrame, parts, drop: list[str] = ()) -> DataFrame:
    """One row per chunk; every other column of the document is carried along."""
    keep = [c for c in docs.columns if c not in drop]
    return explode_list(docs, keep, parts, "chunk", "chunk_no").withColumn("n_chars", F.length("chunk"))


def parent_child(docs: DataFrame, id: str = "doc_id", text: str = "text", parent=(600, 50),
                 child=(150, 15)) -> tuple[DataFrame, DataFrame]:
    """``(parents, children)``: a parent is ``(doc_id, parent_no)``, a child adds its ``child_no``."""
    cut = docs.select(F.col(id).alias("doc_id"), recursive(F.col(text), *parent).alias("parts"))
    parents = explode_list(cut, ["doc_id"], "parts", "parent", "parent_no")
    cut = parents.withColumn("parts", recursive(F.col("parent"), *child))
    children = explode_list(cut, ["doc_id", "parent_no"], "parts", "child", "child_no")
    return parents.select("doc_id", "parent_no", "parent"), children


FENCE = "```"
SHIELD = "\u0002"
HEADER = r"^\s*(#{1,3})\s+(.*?)\s*$"


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _header_paths(lines: Column) -> Column:
    """``ARRAY<STRUCT<h1,h2,h3,at>>``: header path of each section and the line it starts at."""
    marked = F.transform(lines, lambda line, i: F.struct(
        i.alias("at"), F.length(F.regexp_extract(line, HEADER, 1)).alias("level"),
        F.regexp_extract(line, HEADER, 2).alias("title")))
    top = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("level"), F.lit("").alias("title"))
    heads = F.concat(F.array(top), F.filter(marked, lambda m: m["level"] > 0))

    def step(state, head):
        level, title = head["level"], head["title"]
        h1 = F.when(level == 1, title).when(level > 1, state["h1"])
        h2 = F.when(level == 2, title).when(level > 2, state["h2"])
        h3 = F.when(level == 3, title)
        path = F.struct(h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), head["at"].alias("at"))
        return F.struct(h1.alias("h1"), h2.alias("h2"), h3.alias("h3"),
                        F.array_append(state["paths"], path).alias("paths"))

    nothing = F.lit(None).cast("string")
    start = F.struct(
        nothing.alias("h1"), nothing.alias("h2"), nothing.alias("h3"),
        F.array().cast("array<struct<h1:string,h2:string,h3:string,at:int>>").alias("paths"))
    return F.aggregate(heads, start, step, lambda s: s["paths"])


def header_sections(text) -> Column:
    """``ARRAY<STRUCT<h1,h2,h3,content>>`` of a Markdown text, cut at ``#``, ``##`` and ``###``.

    A header resets the deeper levels. Header lines are not part of the content, sections
    without content are dropped, and ``#`` inside fenced code starts no section.
    """
    shielded = F.array_join(F.transform(F.split(text, FENCE), lambda p, i: F.when(
        i % 2 == 1, F.replace(p, F.lit("#"), F.lit(SHIELD))).otherwise(p)), FENCE)

    def body(lines, paths, path, j):
        end = F.coalesce(F.get(paths, j + 1)["at"], F.size(lines))
        inside = F.slice(lines, path["at"] + 2, end - path["at"] - 1)
        return F.struct(
            path["h1"].alias("h1"), path["h2"].alias("h2"), path["h3"].alias("h3"),
            F.trim(F.replace(F.array_join(inside, "\n"), F.lit(SHIELD), F.lit("#"))).alias("content"))

    sections = _bind(F.split(shielded, "\n"), lambda lines: _bind(
        _header_paths(lines), lambda paths: F.transform(
            paths, lambda path, j: body(lines, paths, path, j))))
    return F.filter(sections, lambda s: s["content"] != "")


def header_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per section with its header path."""
    cut = docs.withColumn("_sections", header_sections(F.col(text)))
    rest = [c for c in docs.columns if c != text]
    return (explode_list(cut, rest, "_sections", "s", "chunk_no")
            .select(*rest, "chunk_no", "s.h1", "s.h2", "s.h3", F.col("s.content").alias("chunk")))


def compare_strategies(docs: DataFrame, group: str = "lang", text: str = "text", size: int = 150,
                       overlap: int = 20, percentile: float = 90.0) -> DataFrame:
    """Chunk count and lengths per strategy and document class."""
    parts = semantic_parts(docs, text, percentile).withColumn(
        "recursive", recursive(F.col(text), size, overlap))
    lists = F.array(*[F.struct(F.lit(name).alias("strategy"), F.col(name).alias("parts"))
                      for name in ("recursive", "semantic")])
    rows = explode_list(parts.select(group, F.inline(lists)), [group, "strategy"], "parts", "chunk")
    length = F.length("chunk")
    return rows.groupBy("strategy", group).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.round(F.avg(length), 6).alias("avg_chars"),
        F.min(length).alias("min_chars"), F.max(length).alias("max_chars"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
