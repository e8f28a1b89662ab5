"""Entity resolution by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.clean import first_initial, name_key


def unique_names(people: DataFrame, person_id: str, names: Sequence[str]) -> DataFrame:
    """One row per normalised name: how many people carry it, and one of their ids.

    Grouped with map-side combine, so the join below never multiplies rows.
    """
    known = people.where(F.col(person_id).isNotNull())
    for n in names:
        known = known.where(F.col(n).isNotNull())
    return known.groupBy(*[name_key(n).alias(f"__n_{n}") for n in names]).agg(
        F.count("*").alias("__people"), F.min(person_id).alias("__person")
    )


def fill_id_by_unique_name(
    df: DataFrame, people: DataFrame, person_id: str, names: Sequence[str], id_column: str, count_column: str
) -> DataFrame:
    """Fill a missing id from the name, only where exactly one person has the name."""
    keyed = df.select("*", *[name_key(n).alias(f"__n_{n}") for n in names])
    found = keyed.join(unique_names(people, person_id, names), [f"__n_{n}" for n in names], "left")
    filled = F.when(F.col(id_column).isNotNull(), F.col(id_column)).when(
        F.col("__people") == 1, F.col("__person")
    )
    kept = [c for c in df.columns if c != id_column]
    return found.select(*kept, filled.alias(id_column), F.col("__people").alias(count_column))


def _surname_and_initial(surname: str, given: str) -> list[Column]:
    return [
        F.trim(F.lower(F.col(surname))).alias("__surname"),
        first_initial(F.trim(F.lower(F.col(given)))).alias("__initial"),
    ]


def exclude_by_initial(
    df: DataFrame, surname: str, given: str, known: DataFrame, known_surname: str, known_given: str
) -> DataFrame:
    """Drop rows whose surname and first initial belong to a known person.

    A row without surname or given name matches nobody and stays.
    """
    keys = known.select(*_surname_and_initial(known_surname, known_given)).distinct()
    keyed = df.select("*", *_surname_and_initial(surname, given))
    return keyed.join(keys, ["__surname", "__initial"], "left_anti").select(*df.columns)


def match_by_name(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> DataFrame:
    """Left join on a derived name key; a null key matches nothing."""
    keyed_left = left.withColumn("__name", left_key)
    keyed_right = right.withColumn("__name_right", right_key)
    joined = keyed_left.join(keyed_right, F.col("__name") == F.col("__name_right"), "left")
    return joined.drop("__name", "__name_right")


def match_by_unique_name(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column, count: str) -> DataFrame:
    """Left join on a derived name key, only where one row on each side has the name.

    ``count`` gets the number of rows on the right with the name (0: none). Both sides are counted by name with
    map-side combine first, so a name on a third of the rows joins as one row.
    """
    fields = F.struct(*right.columns)
    named = right.select(right_key.alias("__name"), fields.alias("__row")).where(F.col("__name").isNotNull())
    single = named.groupBy("__name").agg(F.count("*").alias(count), F.any_value("__row").alias("__row"))
    keyed = left.withColumn("__name", left_key)
    carriers = keyed.where(F.col("__name").isNotNull()).groupBy("__name").agg(F.count("*").alias("__carriers"))
    joined = keyed.join(single.join(carriers, "__name"), "__name", "left")
    unique = (F.col(count) == 1) & (F.col("__carriers") == 1)
    shown = [F.when(unique, F.col(f"__row.{c}")).alias(c) for c in right.columns]
    return joined.select(*left.columns, *shown, F.coalesce(count, F.lit(0)).alias(count))
