"""Keep one row per key, chosen the same way whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``.

    Rank and filter stand next to each other so that the plan gets a partial
    WindowGroupLimit: each map task sends at most one row per key, and a key that
    holds a third of the table costs the final task one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = ("loaded_at", "source_file"),
    same: Sequence[str] = (),
) -> DataFrame:
    """The newest row per key. Ties go on to the remaining columns, ascending, so
    two rows that still tie are equal and either is right. Columns named in ``same``
    agree in all rows of a key and need not be sorted by."""
    newest = [F.col(c).desc_nulls_last() for c in latest]
    rest = [F.col(c).asc_nulls_first() for c in sorted(df.columns) if c not in {*keys, *latest, *same}]
    return keep_first(df, keys, newest + rest)
