"""Helpers shared by the operators: whole tables, written cuts of the lineage, file access from tasks."""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import shared_dir

# Words of a text: everything between the six ASCII blanks. ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows hold whole texts, so a batch handed to Python has at most 1,000 of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def pieces(texts: Sequence[str], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters in all, so that what is made of them at a time is bounded however
    long the texts of a batch are together; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def worker_memory() -> dict:
    """What this Python worker keeps from task to task, by name. The functions of this package come anew with every
    task, so it is kept with the interpreter."""
    return vars(sys).setdefault("_kept_from_task_to_task", {})


def let_go() -> None:
    """Free what earlier tasks of other operators left in this Python worker."""
    if held := worker_memory():
        held.clear()
        gc.collect()


def sample(docs: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of ``docs`` whose doc_id is among the first ``n`` of ``keys`` in order of a hash.

    Ids are picked before texts are touched; the picked ids are at most ``n`` rows, so they are broadcast.
    Other columns of ``keys`` come along.
    """
    picked = keys.orderBy(F.xxhash64("doc_id"), *keys.columns).limit(n)
    rows = docs.join(F.broadcast(picked), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(n)


def words(text: str) -> Column:
    """SQL form of the words of a text column; null has none."""
    return F.expr(f"regexp_extract_all(coalesce({text}, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0)")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the cluster."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from the files,
    whatever executor is lost."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(path: str):
    """The file system of a path in the shared folder, as tasks see it, and the path on it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")
