"""Ordered text lists per group (string aggregation), and their items as rows.

A list is one cell of one row, whatever its size; a group beyond a task is listed in ranges of its order. Where lists may outgrow a cell, take ``list_items``: the same
items as rows, with their sort columns, without any grouping.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A text cell holds less than 2 GiB; a longer list fails and names its group.
CELL_BYTES = (1 << 31) - (1 << 16)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("\n", "\\n").replace("'", "\\'") + "'"


def _listagg(separator: str, order: Sequence[str], text: str = "__item") -> Column:
    by = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    return F.expr(f"listagg({text}, {_literal(separator)}) WITHIN GROUP (ORDER BY {by})")


def text_list(
    df: DataFrame,
    keys: Sequence[str],
    item: Column,
    order: Sequence[Column],
    separator: str,
    alias: str,
    aggregates: Sequence[Column] = (),
    cell_bytes: int = CELL_BYTES,
    ranges: int | None = None,
) -> DataFrame:
    """Group by ``keys``: one row per group with the aggregates and the ordered list of ``item``.

    Null items are left out; a group without items has a null list. Equal places in ``order`` go by the item. A list
    of more than ``cell_bytes`` fails and names its keys.

    Without ``ranges`` a group's list is made in one pass by one task, which suits groups that fit a task many times
    over. With ``ranges`` the items are dealt into so many ranges of (keys, order): a group that fills a third of the
    table is sorted and joined by many tasks, and only its finished pieces meet, after their sizes were compared with a
    cell. The input is then read three times: for the ranges, the pieces and the aggregates.
    """
    keys = list(keys)
    named = df.select("*", item.alias("__item"), *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    by = [*(f"__o{i}" for i in range(len(order))), "__item"]
    if ranges:
        return _in_ranges(named, keys, by, separator, alias, list(aggregates), cell_bytes, ranges)
    size = _bytes(F.col("__item"), separator)
    if keys:
        # lists do not get smaller before they move, so items move as plain rows and not as lists of one or two items
        named = named.repartition(*keys)
    grouped = named.groupBy(*keys).agg(*aggregates, _listagg(separator, by).alias(alias), size.alias("__bytes"))
    measures = [c for c in grouped.columns if c not in {*keys, alias, "__bytes"}]
    text = _fitting(F.col(alias), F.coalesce("__bytes", F.lit(0)), keys, alias, cell_bytes)
    return grouped.select(*keys, *measures, text.alias(alias))


def _bytes(text: Column, separator: str) -> Column:
    return F.sum((F.octet_length(text) + F.lit(len(separator.encode()))).cast("bigint"))


def _fitting(text: Column, size: Column, keys: Sequence[str], alias: str, cell_bytes: int) -> Column:
    group = F.to_json(F.struct(*keys)) if keys else F.lit("all rows")
    too_long = F.raise_error(F.concat(F.lit(f"list {alias} does not fit a cell: "), group)).cast("string")
    return F.when(size <= cell_bytes, text).otherwise(too_long)


def _in_ranges(named, keys, by, separator, alias, aggregates, cell_bytes, ranges) -> DataFrame:
    items = named.where(F.col("__item").isNotNull()).select(*keys, *by)
    order = [F.col(c).asc_nulls_last() for c in (*keys, *by)]
    dealt = items.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
    pieces = dealt.groupBy(*keys, "__range").agg(_listagg(separator, by).alias("__piece"))
    # the sizes of a group's pieces are added up before any are joined
    whole = _bytes(F.col("__piece"), separator).over(Window.partitionBy(*keys))
    checked = pieces.withColumn("__whole", whole)
    checked = checked.withColumn("__piece", _fitting(F.col("__piece"), F.col("__whole"), keys, alias, cell_bytes))
    lists = checked.groupBy(*keys).agg(_listagg(separator, ["__range"], "__piece").alias(alias))
    own = [f"__k{i}" for i in range(len(keys))]
    groups = named.groupBy(*keys).agg(*(aggregates or [F.count(F.lit(1)).alias("__n")])).drop("__n")
    same = [groups[k].eqNullSafe(F.col(o)) for k, o in zip(keys, own)] or [F.lit(True)]
    return groups.join(lists.toDF(*own, alias), reduce(Column.__and__, same), "left").drop(*own)


def list_items(df: DataFrame, keys: Sequence[str], item: Column, order: Sequence[Column], alias: str) -> DataFrame:
    """The items that ``text_list`` would join, one row each: keys, ``order_0``, ``order_1``, … and ``alias``."""
    places = [o.alias(f"order_{i}") for i, o in enumerate(order)]
    return df.select(*keys, *places, item.alias(alias)).where(F.col(alias).isNotNull())
