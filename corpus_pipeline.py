"""Preparing a training corpus: rules, near duplicates, decontamination, mixture, token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import decontaminate, mixture, ngram_join, quality, tokens
from recordmill.llm.common import read, small_batches, workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line model keep."""
    model = quality.fit(read(small_batches(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.filtered(docs, model).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one with the smallest id, null last.

    Rows are told apart by id and text together: rows without an id, or of one id with different texts, are judged one
    by one, and rows that agree in both are copies, of which one stays. Texts without words are classes of their own.
    """
    small_batches(spark)
    docs, mark = docs.select(*COLUMNS), F.xxhash64("doc_id", "text")
    classes = ngram_join.joined(docs.select(mark.alias("doc_id"), "text")).select(F.col("doc_id").alias("mark"), "class_id").distinct()
    by_id = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("first")
    first = docs.select("doc_id", mark.alias("mark")).join(classes, "mark").groupBy("class_id").agg(by_id).select("first.mark")
    stay = docs.withColumn("mark", mark).join(first, "mark", "left_semi")
    return stay.select(*COLUMNS).dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.cleaned(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it; rows of one id go by the one that is taken most often."""
    taken = mixture.mixed(docs).groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").cast("int").alias("copies")).where("copies > 0")
    each = docs.select(*COLUMNS).join(taken, docs["doc_id"].eqNullSafe(taken["id"]))
    return each.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as id files, read back: doc_id, start, n_tokens, ids_crc32."""
    small_batches(spark)
    return tokens.encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    folder = workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = f"{folder}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
