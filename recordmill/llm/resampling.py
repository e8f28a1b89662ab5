"""Importance resampling towards a target distribution.

Every feature of a text falls into a hashed bucket. The bucket counts of the corpus and of the target give an array of
gains, from which each document is scored in one pass. The draw is a numeric threshold: repeated exact count jobs over
the stored scores bisect the score of the last drawn row, then its place among rows of the same score. The rows up to
the threshold are range-partitioned for their ranks; no other row moves.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import workspace, written
from recordmill.llm.pieces import pieces

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
HALVINGS = 3  # steps of the bisection that one count job answers
RANGE_ROWS = 1 << 20  # drawn rows of one range

# Words in UTF-8, after lower-casing A to Z: digits, letters of ASCII, all bytes of other characters.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def feature_buckets(text: str, width: int = 1, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Per piece of a text: its number of words and the buckets of its runs of 1 to ``width`` words."""
    last: list[bytes] = []
    for piece in pieces(text.encode("utf-8", "surrogatepass"), _GAP):
        found = _WORDS.findall(piece.lower())
        runs = found
        if width > 1:
            joint, old = last + found, len(last)
            runs = [b" ".join(joint[end - n : end]) for end in range(old + 1, len(joint) + 1) for n in range(1, min(width, end) + 1)]
            last = joint[1 - width :]
        yield len(found), np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs)).astype(np.int64) % buckets


def bucket_counts(docs: DataFrame, width: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts of ``docs`` per bucket. A task sends one row per bucket, the driver gets ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py() or "", width, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed distributions per bucket, rounded down."""
    n, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(float(t) + 1) * (all_s + n) / ((float(s) + 1) * (all_t + n)) for s, t in zip(corpus, target)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel number from the hash of a document's id (no text for null), rounded down."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, width: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of ``docs`` (doc_id, text)."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n_words = n = total = 0
                for words, found in feature_buckets(text.as_py() or "", width, buckets):
                    n_words, n, total = n_words + words, n + len(found), total + int(gain[found].sum())
                weight = total // n if n else 0
                rows.append((doc_id, n_words, n, weight, weight + noise(doc_id, seed)))
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORED)


def cutoff(rows: DataFrame, order: list[str], k: int) -> list[int]:
    """Values of the long columns ``order`` (no nulls) of the k-th row in that order, for 1 <= k <= rows.

    A column is bisected by exact counts, ``HALVINGS`` steps a job, over the rows that agree in the columns before;
    columns are left out when all rows that agree so far are among the k.
    """
    bound: list[int] = []
    for name in order:
        column = F.col(name)
        lo, hi, n = rows.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
        if bound and n == k:
            break
        before = 0  # rows below lo
        while lo < hi:
            parts = 1 << HALVINGS
            cuts = sorted({lo + (hi - lo) * i // parts for i in range(1, parts)})
            found = rows.where(column.between(lo, hi)).agg(*[F.count_if(column <= c) for c in cuts]).first()
            counts = [before + c for c in found]
            low = [(c, n) for c, n in zip(cuts, counts) if n < k]
            hi = min([c for c, n in zip(cuts, counts) if n >= k], default=hi)
            if low:
                lo, before = low[-1][0] + 1, low[-1][1]
        bound.append(lo)
        k -= before
        rows = rows.where(column == lo)
    return bound


def at_most(order: list[str], bound: list[int]) -> Column:
    """Rows that do not come after ``bound`` in the order of the columns."""
    out = F.lit(True)
    for name, value in reversed(list(zip(order, bound))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def ranked(rows: DataFrame, order: list[str], n: int, folder: str) -> DataFrame:
    """``rows`` (``n`` of them) with their ``rank`` from 1 in the order of the columns, which no two rows share.

    Rows are dealt into ranges and sorted there; a row's place is its position in its range plus the sizes of the
    ranges before. Sizes are one row per range of about ``RANGE_ROWS`` rows.
    """
    spark = rows.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, -(-n // RANGE_ROWS))
    placed = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = written(placed, folder, "ranges")
    piece = F.shiftright("place", 33)
    sizes, offsets, total = placed.groupBy(piece.alias("piece")).count().collect(), [], 0
    for r in sorted(sizes, key=lambda r: r["piece"]):
        offsets.append((r["piece"], total))
        total += r["count"]
    table = F.broadcast(spark.createDataFrame(offsets, "piece long, before long"))
    in_piece = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("piece", piece).join(table, "piece").withColumn("rank", F.col("before") + in_piece + 1)


def resampled(docs: DataFrame, target: DataFrame, width: int = 1, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of ``docs``.

    ``docs`` needs doc_id and text, ``target`` text; other columns are not read. A null or empty text has no features,
    weight 0 and is never drawn; texts are read in pieces, whatever their length. Of rows with one score the smaller
    doc_id comes first and null last; rows that agree in both go by fewer features, and rows that agree in all are
    told apart by their place in the stored scores, so repeated rows are drawn one by one and the number drawn is
    exact. Empty tables give an empty result or, as the target, equal gains by corpus counts only.
    """
    folder = workspace(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs, width), bucket_counts(target, width))
    rows = scored(docs, gain, width, seed).select(
        "*",
        (-F.col("score")).alias("falling"), F.col("doc_id").isNull().cast("long").alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, folder, "scores")
    order = ["falling", "nameless", "id", "n_features", "row"]
    out = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= min_words
    k = percent * rows.where(eligible).count() // 100
    if not k:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = eligible & at_most(order, cutoff(rows.where(eligible), order, k))
    top = ranked(rows.where(drawn), order, k, folder)
    return rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(top.select(*out, "rank"))
