"""Row-wise reshaping: exploded lists, dropped markers, wide years to rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_list(df: DataFrame, column: str, separator: str) -> DataFrame:
    """One row per trimmed list item; a row with a null list stays as one row."""
    items = F.split(F.col(column), re.escape(separator))
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode_outer(items).alias(column)).select(
        *[F.trim(c).alias(c) if c == column else c for c in df.columns]
    )


def drop_marker(df: DataFrame, column: str, marker: str) -> DataFrame:
    """Drop rows that hold the placeholder; null is not the placeholder."""
    return df.where(~F.col(column).eqNullSafe(F.lit(marker)))


def _year_columns(df: DataFrame) -> dict[str, dict[int, str]]:
    found: dict[str, dict[int, str]] = {}
    for c in df.columns:
        m = re.fullmatch(r"(.+)_(\d{4})", c)
        if m:
            found.setdefault(m.group(1), {})[int(m.group(2))] = c
    return found


def years_to_rows(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``<metric>_<year>`` columns to one row per id and year, metrics side by side."""
    metrics = _year_columns(df)
    years = sorted({y for by_year in metrics.values() for y in by_year})
    rows = [
        F.struct(
            F.lit(y).alias("anno"),
            *[
                (F.col(by[y]) if y in by else F.lit(None).cast(df.schema[next(iter(by.values()))].dataType)).alias(m)
                for m, by in metrics.items()
            ],
        )
        for y in years
    ]
    return df.select(*ids, F.explode(F.array(*rows)).alias("__y")).select(*ids, "__y.*")


def unpivot_years(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``<metric>_<year>`` columns to (ids, metric, anno, value)."""
    wide = [c for by in _year_columns(df).values() for c in by.values()]
    long = df.unpivot(list(ids), wide, "__name", "value")
    return long.select(
        *ids,
        F.regexp_extract("__name", r"^(.+)_\d{4}\z", 1).alias("metric"),
        F.regexp_extract("__name", r"_(\d{4})\z", 1).cast("int").alias("anno"),
        "value",
    )
