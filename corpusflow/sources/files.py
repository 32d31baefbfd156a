"""File readers. Each gives ``text, file_name, file_type, location, metadata`` rows, lazily.

A reader is a function ``(spark, path) -> DataFrame``; ``READERS`` maps lower-case extensions to
readers and takes new ones. A missing path gives an empty table, what cannot be read goes to
``quarantine`` with a reason, and unknown extensions are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunking import explode_chunks, recursive
from ..plans.ranking import explode_list
from ..plans.sizing import broadcast_if_small, path_exists
from .blocks import csv_fields, csv_header, csv_records, json_elements

SCHEMA = ("text string, file_name string, file_type string, location string, "
          "metadata map<string,string>")

# File types and locations by extension.
FILE_TYPES = {".pdf": "PDF", ".csv": "CSV", ".json": "JSON", ".txt": "Text", ".md": "Markdown"}
WHOLE = "Full Document"


def _place() -> list[Column]:
    return [_plain("_metadata.file_name").alias("_file"), _plain("_metadata.file_path").alias("_path")]


def _plain(encoded: str) -> Column:
    """Scans name their files with URI escapes; a plus sign is none."""
    return F.url_decode(F.replace(F.col(encoded), F.lit("+"), F.lit("%2B")))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def extension(path) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def file_type(ext: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, label in FILE_TYPES.items():
        kind = F.when(ext == name, F.lit(label)).otherwise(kind)
    return kind


def _document(rows: DataFrame, text, kind, location) -> DataFrame:
    name = F.col("_file")
    return rows.select(
        text.alias("text"), name.alias("file_name"), kind.alias("file_type"),
        location.alias("location"),
        F.create_map(F.lit("source"), name, F.lit("path"), F.col("_path")).alias("metadata"))


def _reader(spark: SparkSession, glob: str):
    """Files that vanish or break off while they are read give what was read; ``quarantine`` lists them."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True))


def _any_case(ext: str) -> str:
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in ext.lstrip("."))


def read_text(spark: SparkSession, path: str, ext: str = ".txt") -> DataFrame:
    """One document per file, whatever its length; files that are not UTF-8 go to ``quarantine``."""
    rows = _reader(spark, _any_case(ext)).text(path, wholetext=True).select("value", *_place()).where(F.is_valid_utf8("value"))
    return _document(rows, F.col("value"), F.lit(FILE_TYPES[ext]), F.lit(WHOLE))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    return read_text(spark, path, ".md")


def row_text(names: Column, fields: Column) -> Column:
    """``column: value`` lines of a record."""
    return F.array_join(F.zip_with(names, fields, lambda n, v: F.concat(n, F.lit(": "), F.trim(F.coalesce(v, F.lit(""))))), "\n")


def _pieces(path: str, ext: str, separator: str):
    """Reader of ``(value, _path, _block)``: what stands between separators, in the order of the file."""
    def read(session: SparkSession) -> DataFrame:
        return _reader(session, _any_case(ext)).text(path, lineSep=separator).select(
            "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    return read


def _named(rows: DataFrame) -> DataFrame:
    """Plain paths and file names in place of escaped ones."""
    return rows.withColumn("_path", _plain("_path")).withColumn("_file", F.regexp_extract("_path", r"([^/]+)$", 1))


def _csv(spark: SparkSession, path: str, columns: list[str] | None, quoted: bool) -> DataFrame:
    """Records with their fields and the column names of their file; ``reason`` says what is wrong with one."""
    rows = csv_records(spark, _pieces(path, ".csv", "\n"), quoted).withColumn("fields", csv_fields("record"))
    body = rows.where("record_no > 0")
    if columns:
        body = body.withColumn("names", F.array(*[F.lit(c.strip()) for c in columns]))
    else:
        heads = rows.where("record_no = 0").select("_path", csv_header("record").alias("names"))
        body = body.join(broadcast_if_small(heads, "length(_path) + 256"), "_path")  # one row for each file
    reason = (F.when(~F.col("decoded"), "not UTF-8").when(F.col("fields").isNull(), "open quote")
              .when(F.size("fields") != F.size("names"), "does not fit the header"))
    return _named(body.withColumn("reason", reason))


def read_csv(spark: SparkSession, path: str, multi_line: bool = True,
             columns: list[str] | None = None) -> DataFrame:
    """One document per record, located by its 0-based row in the file.

    Records are those of RFC 4180: a quoted field may hold line breaks, a doubled quote stands for
    one. A file is read by as many tasks as it has blocks. ``multi_line=False`` takes every line
    for a record. ``columns`` are used in place of the files' own headers.
    """
    rows = _csv(spark, path, columns, multi_line).where("reason IS NULL")
    where = F.concat(F.lit("Row "), (F.col("record_no") - 1).cast("string"))
    return empty(spark).unionByName(_document(rows, row_text(F.col("names"), F.col("fields")), F.lit("CSV"), where))


def quarantined_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Records that are not UTF-8, leave a quote open or do not fit their header, with their file."""
    rows = _csv(spark, path, columns, multi_line).where("reason IS NOT NULL")
    return _rejects(spark).unionByName(rows.select(F.col("_file").alias("file_name"), "record", "reason"))


def _rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file_name string, record string, reason string")


def json_records(rows: DataFrame, column: str = "value") -> DataFrame:
    """Elements of a top-level JSON array, numbered from 1. Text that is no array gives no row."""
    items = explode_list(rows, [c for c in rows.columns if c != column],
                         F.from_json(column, "array<string>"), "record", "record_no")
    return items.withColumn("record_no", F.col("record_no") + 1)


def _json(spark: SparkSession, path: str, ext: str) -> DataFrame:
    """Elements of each file with their value as text; ``reason`` says what is wrong with one or its file."""
    rows, kinds = json_elements(spark, _pieces(path, ext, ","))
    kinds = kinds.withColumnRenamed("values", "n_values")
    rows = rows.join(broadcast_if_small(kinds, "length(_path) + 64"), "_path")  # one row for each file
    first, last = F.col("record_no") == 0, F.col("record_no") == F.col("elements") - 1
    # Off come the file's own brackets, and the comma that closes every piece.
    body = F.when(first, F.regexp_replace("record", r"^\uFEFF?\s*[\[{]", "")).otherwise(F.col("record"))
    body = F.when(last, F.regexp_replace(body, r"\s*[\]}]\s*,?\s*$", "")).otherwise(body)
    rows = rows.withColumn("body", F.trim(F.regexp_replace(body, r"^\s+|\s+$", "")))
    whole = F.coalesce(F.col("opens").isin("[", "{"), F.lit(False)) & (F.col("depth") == 0) & (F.col("inside") == 0) & (F.col("n_values") == 1)
    closes = F.when(F.col("opens") == "[", F.lit("]")).otherwise(F.lit("}"))
    whole = whole & (~last | F.rtrim(F.regexp_replace("record", r"[\s,]+$", "")).endswith(closes))
    items = F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), "array<string>")
    members = F.map_values(F.from_json(F.concat(F.lit("{"), F.col("body"), F.lit("}")), "map<string,string>"))
    rows = rows.withColumn("values", F.when(F.col("opens") == "[", items).otherwise(members))
    blank = (F.col("body") == "") & (F.col("elements") == 1) & whole  # an empty array or object
    reason = (F.when(~whole, "no JSON array or object").when(~F.col("decoded"), "not UTF-8")
              .when((F.col("body") == "") | F.col("values").isNull() | (F.size("values") != 1), "no JSON value"))
    return _named(rows.where(~blank).withColumn("reason", reason))


def read_json(spark: SparkSession, path: str, ext: str = ".json") -> DataFrame:
    """One document per element of a top-level array or value of a top-level object, numbered from 1.

    A file is read by as many tasks as it has blocks, whether it has line breaks or not.
    """
    rows = _json(spark, path, ext).where("reason IS NULL")
    where = F.concat(F.lit("Record #"), (F.col("record_no") + 1).cast("string"))
    return empty(spark).unionByName(_document(rows, F.get("values", F.lit(0)), F.lit("JSON"), where))


def quarantined_json(spark: SparkSession, path: str, ext: str = ".json") -> DataFrame:
    """Files that are no array or object (their text up to the first border), and elements that cannot be read."""
    rows = _json(spark, path, ext).where("reason IS NOT NULL").where((F.col("reason") != "no JSON array or object") | (F.col("record_no") == 0))
    return _rejects(spark).unionByName(rows.select(
        F.col("_file").alias("file_name"), F.regexp_replace("record", ",$", "").alias("record"), "reason"))


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All that ``read_directory`` leaves out of known files: ``(file_name, record, reason)``.

    Files that have bytes but gave no row, as they could not be opened or decompressed, have no
    record. Unknown types are no rejects; a missing path gives an empty table.
    """
    if not path_exists(spark, path):
        return _rejects(spark)
    out = quarantined_csv(spark, path).unionByName(quarantined_json(spark, path))
    for ext in (".txt", ".md"):
        texts = _reader(spark, _any_case(ext)).text(path, wholetext=True).select("value", *_place())
        out = out.unionByName(texts.where(~F.is_valid_utf8("value")).select(
            F.col("_file").alias("file_name"), F.make_valid_utf8("value").alias("record"), F.lit("not UTF-8").alias("reason")))
    seen = [_pieces(path, ext, "\n")(spark).select(_plain("_path").alias("_path")) for ext in READERS]
    seen = reduce(DataFrame.unionByName, seen).distinct()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0")
    bare = lambda path: F.regexp_replace(path, "^file:/+", "file:/")
    listed = listed.select(bare("path").alias("_path")).where(extension(F.col("_path")).isin(list(READERS)))
    lost = listed.join(seen.select(bare("_path").alias("_path")), "_path", "left_anti").withColumn("_file", F.regexp_extract("_path", r"([^/]+)$", 1))
    return out.unionByName(lost.select(F.col("_file").alias("file_name"), F.lit(None).cast("string").alias("record"), F.lit("unreadable").alias("reason")))


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    ".csv": read_csv,
    ".json": read_json,
    ".txt": read_text,
    ".md": read_markdown,
}


def read_directory(spark: SparkSession, path: str, readers=None) -> DataFrame:
    """All known files below ``path`` as documents; a missing path gives an empty table."""
    if not path_exists(spark, path):
        return empty(spark)
    out = empty(spark)
    for read in (readers or READERS).values():
        out = out.unionByName(read(spark, path))
    return out


def load_chunks(spark: SparkSession, path: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Documents of a directory, split, with provenance copied to every chunk."""
    docs = read_directory(spark, path)
    return explode_chunks(docs, recursive(F.col("text"), size, overlap), drop=["text"])


def normalise(rows: DataFrame, path: str = "path", ordinal: str = "ordinal", text: str = "text") -> DataFrame:
    """Uniform provenance from a path and a 0-based ordinal in the file; unknown types go.

    Pages and records are shown from 1, rows as given, a missing ordinal of a row as ``N/A``.
    """
    ext, n = extension(F.col(path)), F.col(ordinal)
    shown = (n + 1).cast("string")
    where = (F.when(ext == ".pdf", F.concat(F.lit("Page "), F.coalesce(shown, F.lit("1"))))
             .when(ext == ".csv", F.concat(F.lit("Row "), F.coalesce(n.cast("string"), F.lit("N/A"))))
             .when(ext == ".json", F.concat(F.lit("Record #"), shown))
             .otherwise(F.lit(WHOLE)))
    kept = [c for c in rows.columns if c not in (path, ordinal, text)]
    return (rows.withColumn("file_type", file_type(ext)).where(F.col("file_type").isNotNull())
            .select(*kept, F.col(text).alias("text"),
                    F.regexp_extract(path, r"([^/]+)$", 1).alias("file_name"), "file_type",
                    where.alias("location")))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop a job that would run on an empty corpus."""
    if df.isEmpty():
        raise ValueError(f"{what} holds no readable document")
    return df


def pdf_pages(pages: DataFrame, file: str = "file_name", page: str = "page", text: str = "text") -> DataFrame:
    """Documents from a table of already decoded pages; the 0-based page is shown from 1."""
    where = F.concat(F.lit("Page "), (F.coalesce(F.col(page), F.lit(0)) + 1).cast("string"))
    return pages.select(F.col(text).alias("text"), F.col(file).alias("file_name"),
                        F.lit("PDF").alias("file_type"), where.alias("location"),
                        F.create_map(F.lit("source"), F.col(file)).alias("metadata"))
