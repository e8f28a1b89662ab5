"""Document files to page texts, with a user function that knows the file format."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators.dedup import keep_first

Extract = Callable[[bytes], Sequence[str]]
DOCUMENT = "document_id string, source_path string, source_file string, pages array<string>, error string"


def discover(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """All matching files below ``root``; the id is the hash of the content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(
            F.sha2("content", 256).alias("document_id"),
            F.regexp_replace("path", r"^file:/+", "/").alias("source_path"),
            F.substring_index("path", "/", -1).alias("source_file"),
            "content",
        )
    )


def first_copies(documents: DataFrame) -> DataFrame:
    """One row per distinct content: of equal files the first path counts.

    Taken after the texts are read, so that texts are shuffled and not file contents.
    """
    return keep_first(documents, ["document_id"], [F.col("source_path").asc()])


def page_texts(files: DataFrame, extract: Extract) -> DataFrame:
    """Pages of every file; a file that cannot be read gets an error, not an exception."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages, errors = [], []
            for content in batch["content"]:
                try:
                    pages.append([p or "" for p in extract(bytes(content))])
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    pages.append(None)
                    errors.append(str(e) or type(e).__name__)
            yield batch[["document_id", "source_path", "source_file"]].assign(pages=pages, error=errors)

    return files.select("document_id", "source_path", "source_file", "content").mapInPandas(read, DOCUMENT)
