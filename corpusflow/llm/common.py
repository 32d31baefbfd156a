"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans.sizing import in_groups, scratch_path  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: columnar, pruned, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MARK = "_COMMITTED"


def set_mark(spark: SparkSession, folder: str) -> None:
    """Say that all files of a batch folder stand; written last, so a folder without it does not count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MARK}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def marked(spark: SparkSession, folder: str) -> list[str]:
    """Batch folders of a store whose mark stands, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch=*/{MARK}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f"{folder}/{x.getPath().getParent().getName()}" for x in found or [])


def table_in(spark: SparkSession, folders: list[str], name: str, schema: str) -> DataFrame:
    """The table ``name`` of all given batch folders; empty without any."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{f}/{name}" for f in folders])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind an expression once, so that Catalyst cannot repeat it wherever ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(doc_id: str, folds: int = 4) -> Column:
    """Fold of a row by the CRC-32 of its id as text; rows without an id are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0)).cast("int")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the given columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given working names, lengthened until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
