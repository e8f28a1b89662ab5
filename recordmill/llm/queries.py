"""The operators over the whole given tables, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.llm import (
    decontaminate, filter_audit, language, mixture, ngram_join, pii, quality, resampling, secret_scan, sharding, substring, tokens, warc,
)
from recordmill.llm.common import read, small_batches
from recordmill.llm.oracle import ORACLE as ORACLE


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(small_batches(spark), sf_dir, "documents")
    return pii.detected(docs, pii.fit(docs))


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(read(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(read(small_batches(spark), sf_dir, "documents"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(read(small_batches(spark), sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(read(small_batches(spark), sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(small_batches(spark), sf_dir, "pages")).drop("url")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(read(small_batches(spark), sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    rows, _ = sharding.resharded(docs)
    # a block holds few rows, and the rows before it in its shard are known
    in_block = Window.partitionBy("old_shard", "block").orderBy("doc_id", "text_crc32", "size")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.row_number().over(in_block) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(small_batches(spark), sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(read(small_batches(spark), sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(small_batches(spark), sf_dir, "documents")
    return language.identified(docs, language.fit(docs))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(read(small_batches(spark), sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_mixture": op2_mixture,
    "op3_ngram_join": op3_ngram_join,
    "op4_substring": op4_substring,
    "op5_secrets": op5_secrets,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc": op7_warc,
    "op8_tokens": op8_tokens,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_resampling": op11_resampling,
    "op12_language": op12_language,
    "op13_filter_audit": op13_filter_audit,
}
