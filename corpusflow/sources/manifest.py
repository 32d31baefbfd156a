"""Which batches of a store count: a batch folder does once its mark stands, until a later one replaces it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

MARK = "_COMMITTED"
REPLACES = "_REPLACES."


def _system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _found(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """``(batch, file)`` names of the marks that match."""
    path, system = _system(spark, pattern)
    return [(x.getPath().getParent().getName(), x.getPath().getName()) for x in system.globStatus(path) or []]


def set_mark(spark: SparkSession, folder: str, replaces: Sequence[str] = ()) -> None:
    """Say that all files of a batch stand, and which batches it takes the place of; written last."""
    for name in [REPLACES + old.rpartition("/")[2] for old in replaces] + [MARK]:
        path, system = _system(spark, f"{folder}/{name}")
        system.create(path, True).close()


def active(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the batches that count, by name."""
    marked = {batch for batch, _ in _found(spark, f"{folder}/batch=*/{MARK}")}
    gone = {old.removeprefix(REPLACES) for batch, old in _found(spark, f"{folder}/batch=*/{REPLACES}*") if batch in marked}
    return [f"{folder}/{batch}" for batch in sorted(marked - gone)]


def state_of(spark: SparkSession, path: str) -> str:
    """Changes when a file of a table does: names, sizes and times of its files."""
    root, system = _system(spark, path)
    files, out = system.listFiles(root, True), []
    while files.hasNext():
        file = files.next()
        out.append(f"{file.getPath()}:{file.getLen()}:{file.getModificationTime()}")
    return "\n".join(sorted(out))
