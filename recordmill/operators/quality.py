"""Data-quality checks: one result row per check, with severity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Check:
    """A rule on one table.

    kind: ``not_null``, ``expression``, ``allowed``, ``unique`` or ``relationship``.
    """

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    expression: str | None = None
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}.{'_'.join(self.columns)}"

    @property
    def details(self) -> str:
        if self.kind == "expression":
            return self.expression
        if self.kind == "allowed":
            return ", ".join(self.values)
        if self.kind == "relationship":
            return f"{self.parent}.{self.parent_column}"
        return ", ".join(self.columns)

    def row_fails(self) -> Column:
        """For the checks that look at one row; a null outcome passes."""
        column = F.col(self.columns[0])
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "allowed":
            return column.isNotNull() & ~column.isin(*self.values)
        return F.coalesce(~F.expr(self.expression), F.lit(False))


def not_null(table: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check(table, "not_null", (c,), severity=severity) for c in columns]


def unique(table: str, *columns: str, severity: str = "error") -> Check:
    return Check(table, "unique", columns, severity=severity)


def relationship(table: str, column: str, parent: str, parent_column: str, severity: str = "error") -> Check:
    return Check(table, "relationship", (column,), parent=parent, parent_column=parent_column, severity=severity)


def expression(table: str, column: str, rule: str, severity: str = "error") -> Check:
    return Check(table, "expression", (column,), expression=rule, severity=severity)


def allowed(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    return Check(table, "allowed", (column,), values=tuple(values), severity=severity)


ROW_KINDS = ("not_null", "expression", "allowed")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null are not compared."""
    known = reduce(lambda d, c: d.where(F.col(c).isNotNull()), columns, df)
    return known.groupBy(*columns).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows.

    Values are counted before the join, so a value that fills a third of the child
    table reaches the join as one row.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return values.join(keys, column, "left_anti")


def _key(columns: Sequence[Column]) -> Column:
    """The values of a key as one text; null if one of them is. Of several values each but the last stands behind its
    length, so no two keys share a text."""
    *first, last = [c.cast("string") for c in columns]
    parts = [p for c in first for p in (F.length(c).cast("string"), F.lit(":"), c)]
    return F.concat(*parts, last) if parts else last


def _entries(table: str, checks: Sequence[Check]) -> list[Column]:
    """What a row of a table adds to the checks: (check, key, rows, is_parent) or null.

    A failed row rule counts as one row of the check, without a key; a key counts as a row of it; a value that other
    tables refer to stands as a parent.
    """

    def entry(number: int, key: Column, rows: int) -> Column:
        return F.struct(
            F.lit(number).alias("check"), key.cast("string").alias("key"), F.lit(rows).cast("bigint").alias("rows"),
            F.lit(rows == 0).alias("is_parent"),
        )

    out = []
    for i, c in enumerate(checks):
        if c.table == table and c.kind in ROW_KINDS:
            out.append(F.when(c.row_fails(), entry(i, F.lit(None), 1)))
        elif c.table == table:
            # values that refer to another table are compared as text
            key = _key([F.col(x).cast("string") if c.parent else F.col(x) for x in c.columns])
            out.append(F.when(key.isNotNull(), entry(i, key, 1)))
        if c.kind == "relationship" and c.parent == table:
            key = _key([F.col(c.parent_column).cast("string")])
            out.append(F.when(key.isNotNull(), entry(i, key, 0)))
    return out


def check_counts(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check, observed_value) of the checks with failures, ``check`` being the number in ``checks``.

    Every table is read once: a row is expanded into what it adds to each check, and all entries are grouped by check
    and key in one shuffle, counted before they move. A group with more than one row is a duplicate; a group without
    a parent is an orphan.
    """
    if unknown := {t for c in checks for t in (c.table, c.parent) if t} - set(tables):
        raise KeyError(f"checks of tables that are not given: {sorted(unknown)}")
    parts = []
    for name, df in tables.items():
        entries = _entries(name, checks)
        if entries:
            parts.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    kinds = {k: [i for i, c in enumerate(checks) if c.kind == k] for k in ("unique", "relationship")}
    keyed = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(
        F.sum("rows").alias("rows"), F.bool_or("is_parent").alias("has_parent")
    )
    failed = (
        F.when(F.col("check").isin(kinds["unique"]), (F.col("rows") > 1).cast("bigint"))
        .when(F.col("check").isin(kinds["relationship"]), F.when(F.col("has_parent"), 0).otherwise(F.col("rows")))
        .otherwise(F.col("rows"))
    )
    return keyed.groupBy("check").agg(F.sum(failed).cast("bigint").alias("observed_value"))


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], run_id: str, created_at: str
) -> DataFrame:
    """Result rows for all checks, ready to append to the results table."""
    listed = [(i, c.table, c.name, "WARN" if c.severity == "warn" else "FAIL", c.details) for i, c in enumerate(checks)]
    spark = next(iter(tables.values())).sparkSession
    rules = spark.createDataFrame(listed, "check int, object_name string, check_name string, on_failure string, details string")
    observed = F.coalesce("observed_value", F.lit(0).cast("bigint"))
    return rules.join(F.broadcast(check_counts(tables, checks)), "check", "left").select(
        F.lit(run_id).alias("run_id"),
        "object_name",
        "check_name",
        F.when(observed > 0, F.col("on_failure")).otherwise("PASS").alias("status"),
        observed.alias("observed_value"),
        F.lit(0).cast("bigint").alias("expected_value"),
        "details",
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


class ChecksFailed(RuntimeError):
    pass


def enforce(results: DataFrame) -> None:
    """Raise when a check of severity error failed; call after storing the results.

    The result has one row per check, so the failed ones fit the driver.
    """
    failed = results.where(F.col("status") == "FAIL").select("object_name", "check_name", "observed_value")
    found = [f"{r.object_name}: {r.check_name} ({r.observed_value})" for r in failed.collect()]
    if found:
        raise ChecksFailed("; ".join(sorted(found)))
