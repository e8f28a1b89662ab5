"""Positions of ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.sources.splits import written


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a sorted frame with their place in its order, from 1.

    The sorted ranges are written once; a row's place is its place in its range plus the sizes of the ranges before,
    so no task sees all rows. Sizes are one row per range.
    """
    placed = written(ordered.withColumn("__place", F.monotonically_increasing_id()), "ordered")
    piece = F.shiftright("__place", 33)
    sizes = placed.groupBy(piece.alias("__piece")).count().orderBy("__piece").collect()
    before, rows = 0, []
    for r in sizes:
        rows.append((r["__piece"], before))
        before += r["count"]
    offsets = ordered.sparkSession.createDataFrame(rows, "__piece long, __before long")
    place = F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = placed.withColumn("__piece", piece).join(F.broadcast(offsets), "__piece")
    return joined.select(*ordered.columns, place.alias(name))
