"""Context assembly, prompts, attribution and structured answers.

Ranked rows carry the text and provenance of the document. A query has only its top-k rows, so
collecting them per query is bounded by ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.embed import DIM, sentence_scores, signature
from ..functions.text import sentences
from .retrieval import distinct_sources

SOURCES = "array<struct<file_name:string,file_type:string,location:string>>"
CITED_ANSWER = f"struct<answer:string,sources:{SOURCES}>"
GRADED_ANSWER = ("struct<answer:string,confidence:string,sources_used:array<string>,"
                 "follow_up:string>")


def assemble(ranked: DataFrame, line: Column, separator: str, name: str = "context") -> DataFrame:
    """Render each ranked row with ``line`` (a null one is empty) and join the lines of a query in rank order."""
    rows = F.array_sort(F.collect_list(F.struct("rank", F.coalesce(line, F.lit("")).alias("line"))))
    return ranked.groupBy("query_id").agg(
        F.array_join(F.transform(rows, lambda r: r["line"]), separator).alias(name),
        F.count(F.lit(1)).alias("n_chunks"))


def plain_line() -> Column:
    return F.col("text")


def source_line() -> Column:
    return F.concat(F.lit("Source ("), F.coalesce("source", F.lit("unknown")), F.lit("): "), F.coalesce("text", F.lit("")))


def numbered_line() -> Column:
    return F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] Source "),
                    F.coalesce("source", F.lit("unknown")), F.lit(":\n"), F.coalesce("text", F.lit("")))


def bracket_line() -> Column:
    return F.concat(F.lit("["), F.coalesce("source", F.lit("unknown")), F.lit("]: "), F.coalesce("text", F.lit("")))


def header_line() -> Column:
    def known(name, default):
        return F.coalesce(F.col(name), F.lit(default))

    return F.concat(F.lit("[FILE: "), known("file_name", "unknown"), F.lit(" | TYPE: "), known("file_type", "unknown"),
                    F.lit(" | LOCATION: "), known("location", "N/A"), F.lit("]\n"), known("text", ""))


# Separators between rendered rows.
PLAIN_SEPARATOR = "\n\n"
LINE_SEPARATOR = "\n"
SOURCE_SEPARATOR = "\n---\n"
HEADER_SEPARATOR = "\n\n---\n\n"


def fill_prompt(contexts: DataFrame, queries: DataFrame, template: str) -> DataFrame:
    """Put context and question into a template with ``{context}`` and ``{question}``.

    The template is cut at its marks first, so marks inside the inserted texts stay as they are.
    """
    parts, rest = [], template
    while rest:
        spots = [(rest.find(m), m) for m in ("{context}", "{question}") if m in rest]
        if not spots:
            parts.append(F.lit(rest))
            break
        at, mark = min(spots)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(F.col("context") if mark == "{context}" else F.col("query"))
        rest = rest[at + len(mark):]
    return contexts.join(queries.select("query_id", "query"), "query_id").select(
        "query_id", F.concat(*parts).alias("prompt"))


def metadata_value(metadata: str, key: str, default: str) -> Column:
    """Value of a metadata map, or a default when the key is absent."""
    return F.coalesce(F.try_element_at(F.col(metadata), F.lit(key)), F.lit(default))


def attribution(ranked: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Unique (file_name, file_type, location) of a query's rows, in first-seen order."""
    known = ranked.select(
        "query_id", "rank", metadata_value(metadata, "file_name", "unknown").alias("file_name"),
        metadata_value(metadata, "file_type", "unknown").alias("file_type"),
        metadata_value(metadata, "location", "N/A").alias("location"))
    return distinct_sources(known, ["file_name", "file_type", "location"])


def parse_answers(responses: DataFrame, column: str = "response", schema: str = CITED_ANSWER) -> DataFrame:
    """Decode stored structured answers; a response that is not JSON gives nulls."""
    return responses.withColumn("parsed", F.from_json(column, T._parse_datatype_string(schema))).drop(column)


def compress(ranked: DataFrame, queries: DataFrame, threshold: float, dim: int = DIM) -> DataFrame:
    """Keep only the sentences of each retrieved text that are close to the query.

    Sentence order stays; rows that lose every sentence are dropped. Sizes before and after
    are reported.
    """
    coded = queries.select("query_id", signature("query", dim).alias("_query"))
    rows = ranked.join(coded, "query_id").withColumn("_sent", sentences("text"))
    rows = rows.withColumn("_codes", F.transform("_sent", lambda s: signature(s, dim)))
    rows = rows.withColumn("_scores", sentence_scores(dim)(F.col("_query"), F.col("_codes")))
    kept = F.filter("_sent", lambda s, i: F.get("_scores", i) >= threshold)
    rows = rows.withColumn("_kept", kept).where(F.size("_kept") > 0)
    return rows.select(
        "query_id", "id", *[c for c in ("rank", "score") if c in ranked.columns],
        F.array_join("_kept", " ").alias("compressed"), F.length("text").alias("chars_before"),
    ).withColumn("chars_after", F.length("compressed"))
