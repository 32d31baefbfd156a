"""Token totals kept up to date by signed deltas.

A batch of changes (inserts, deletes, revised counts) becomes one small table of signed sums by
source, language and tokenizer version, stored under the batch's name. Totals are the sum over
stored batches, so they never need the documents again. A batch is stored once its mark stands,
which is written last: one that was stored is not stored twice, however often it is sent, and one
that broke off before counts neither as stored nor in the totals.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans.sizing import scratch_path

from .common import fold_of, marked, set_mark, stored, table_in

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut before byte pairs are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ("source", "lang", "version")
_encoders: dict = {}


def _encoder(version: str, data: bytes, pattern: str):
    """One encoder for each Python worker and vocabulary."""
    if version not in _encoders:
        import tiktoken
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
        _encoders[version] = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[version]


def counted(docs: DataFrame, vocabulary: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, source, lang, version, n_raw, n_clean)``: tokens of the text, and of the text
    with runs of white space made one blank. Null texts have none. The vocabulary is read once
    and sent to the tasks (a bounded file), its name is the tokenizer version."""
    spark = docs.sparkSession
    version = vocabulary.rstrip("/").rpartition("/")[2].rpartition(".")[0]
    data = spark.read.format("binaryFile").load(f"file://{vocabulary}" if vocabulary.startswith("/") else vocabulary).first()["content"]
    sent = spark.sparkContext.broadcast(bytes(data))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(version, sent.value, pattern).encode_ordinary
        for part in parts:
            raw, clean = [], []
            for text in part.column(3).to_pylist():
                text = text or ""
                tidy = " ".join(text.split())
                raw.append(len(encode(text)))
                clean.append(raw[-1] if tidy == text else len(encode(tidy)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array([version] * len(raw), pa.string()), pa.array(raw, pa.int64()), pa.array(clean, pa.int64())],
                ["doc_id", "source", "lang", "version", "n_raw", "n_clean"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, source string, lang string, version string, n_raw long, n_clean long")


class Rollup:
    """Additive totals in a folder of batches.

    ``changes`` have ``op`` (insert, delete, revise), ``before`` and ``after`` (token counts) and
    the key columns, which are strings. A document that moves to another key is a delete there and
    an insert here, in one batch. Null keys are keys; null counts are zero; an unknown or null
    ``op`` is an error. Repeated rows are repeated changes; an empty batch is stored as such.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def _folder(self, batch: str) -> str:
        if not batch or not all(c.isalnum() or c in "._-" for c in batch):
            raise ValueError(f"a batch name is letters, digits, dots and dashes, not {batch!r}")
        return f"{self.path}/batch={batch}"

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch unless it is stored; tells whether it was new."""
        folder = self._folder(batch)
        if folder in marked(self.spark, self.path):
            return False
        known = F.col("op").isin("insert", "delete", "revise")
        op = F.when(F.coalesce(known, F.lit(False)), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
        before, after = (F.coalesce(c, F.lit(0)) for c in ("before", "after"))
        docs = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0).cast("long")
        tokens = F.when(op == "insert", after).when(op == "delete", -before).otherwise(after - before).cast("long")
        (changes.groupBy(*self.keys).agg(F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens"), F.count(F.lit(1)).alias("n_changes"))
         .write.mode("overwrite").parquet(f"{folder}/deltas"))  # one small row for each key
        set_mark(self.spark, folder)
        return True

    def totals(self) -> DataFrame:
        """Documents, tokens and changes of each key over all stored batches; empty without any."""
        schema = ", ".join([*(f"{k} string" for k in self.keys), "n_docs long, n_tokens long, n_changes long"])
        deltas = table_in(self.spark, marked(self.spark, self.path), "deltas", schema)
        return deltas.groupBy(*self.keys).agg(*[F.sum(c).cast("long").alias(c) for c in ("n_docs", "n_tokens", "n_changes")])


def token_totals(docs: DataFrame, vocabulary: str = TOKENIZER) -> DataFrame:
    """Totals of a corpus that comes in four loads, is tidied, and loses its empty documents.

    Loads are inserts by fold of the id; the first is sent twice. Tidying revises every
    document whose count changes without extra white space. Documents without tokens are
    deleted at last. So totals are those of the tidied, non-empty documents.
    """
    spark = docs.sparkSession
    rows = stored(counted(docs, vocabulary), "token-counts").withColumn("fold", fold_of("doc_id"))
    rollup = Rollup(spark, scratch_path(spark, "token-rollup"))

    def changes(op: str, rows: DataFrame, before: str | None, after: str | None) -> DataFrame:
        none = F.lit(None).cast("long")
        return rows.select(*KEYS, F.lit(op).alias("op"), (F.col(before) if before else none).alias("before"),
                           (F.col(after) if after else none).alias("after"))

    for fold in (0, 1, 2, 3, 0):
        rollup.commit(f"load-{fold}", changes("insert", rows.where(F.col("fold") == fold), None, "n_raw"))
    rollup.commit("tidy", changes("revise", rows.where("n_raw <> n_clean"), "n_raw", "n_clean"))
    rollup.commit("purge", changes("delete", rows.where("n_clean = 0"), "n_clean", None))
    return rollup.totals()
