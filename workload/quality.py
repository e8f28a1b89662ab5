"""Data-quality queries: the core checks on derived staging, and each kind on a given table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import quality as dq
from recordmill.plans import core
from recordmill.plans.checks import core_checks
from recordmill.session import shared_dir
from workload.layers import MOBILITY, core_table
from workload.oracle import sql
from workload.staging import staging
from workload.tables import table

QUERIES, ORACLE = {}, {}
THIS_YEAR = 2000
STAMP = "2024-01-01 00:00:00"


def _short(name: str) -> str:
    return "core_mobilita" if name == MOBILITY else f"core_{name}"


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table as stored: the checks read it many times."""
    path = f"{shared_dir(spark)}/checked-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _report(spark: SparkSession, d: str) -> DataFrame:
    checks = core_checks(THIS_YEAR)
    tables = {c.table for c in checks} | {c.parent for c in checks if c.parent}
    return dq.run_checks({t: stored(spark, core_table(spark, d, t)) for t in sorted(tables)}, checks, "r1", STAMP).drop("created_at")


def _check_sql(c: dq.Check) -> str:
    t = _short(c.table)
    if c.kind == "unique":
        keys = ", ".join(c.columns)
        present = " and ".join(f"{k} is not null" for k in c.columns)
        n = f"select count(*) as n from (select 1 from {t} where {present} group by {keys} having count(*) > 1)"
    elif c.kind == "relationship":
        k = c.columns[0]
        n = (
            f"select count(*) as n from {t} where {k} is not null and not exists "
            f"(select 1 from {_short(c.parent)} p where p.{c.parent_column} = {t}.{k})"
        )
    elif c.kind == "not_null":
        n = f"select count(*) as n from {t} where {c.columns[0]} is null"
    else:
        n = f"select count(*) as n from {t} where not ({c.expression})"
    on_failure = "WARN" if c.severity == "warn" else "FAIL"
    return (
        f"select 'r1' as run_id, '{c.table}' as object_name, '{c.name}' as check_name, "
        f"case when n = 0 then 'PASS' else '{on_failure}' end as status, n as observed_value, "
        f"0::bigint as expected_value, '{c.details}' as details from ({n})"
    )


_checks = core_checks(THIS_YEAR)
QUERIES["quality_report"] = _report
ORACLE["quality_report"] = sql(
    " union all ".join(_check_sql(c) for c in _checks), *sorted({_short(c.table) for c in _checks})
)

QUERIES["quality_duplicate_keys"] = lambda spark, d: dq.duplicate_keys(
    table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
)
ORACLE["quality_duplicate_keys"] = (
    'select l_orderkey, l_linenumber, count(*) as "rows" from lineitem group by 1, 2 having count(*) > 1'
)
QUERIES["quality_orphans"] = lambda spark, d: dq.orphans(
    table(spark, d, "lineitem").select((F.col("l_orderkey") + F.col("l_suppkey")).alias("shifted")), "shifted",
    table(spark, d, "orders"), "o_orderkey",
)
ORACLE["quality_orphans"] = (
    'select l_orderkey + l_suppkey as shifted, count(*) as "rows" from lineitem '
    "where l_orderkey + l_suppkey not in (select o_orderkey from orders) group by 1"
)
_RULES = [
    *dq.not_null("orders", "o_orderpriority"),
    dq.expression("orders", "o_totalprice", "o_totalprice between 1000 and 400000"),
    dq.allowed("orders", "o_orderstatus", ("O", "F"), severity="warn"),
]
QUERIES["quality_row_rules"] = lambda spark, d: dq.run_checks(
    {"orders": table(spark, d, "orders")}, _RULES, "r1", STAMP
).drop("created_at")
ORACLE["quality_row_rules"] = """
    select 'r1' as run_id, 'orders' as object_name, name as check_name,
           case when n = 0 then 'PASS' when name = 'allowed.o_orderstatus' then 'WARN' else 'FAIL' end as status,
           n as observed_value, 0::bigint as expected_value, details
    from (select 'not_null.o_orderpriority' as name, 'o_orderpriority' as details,
                 count(*) filter (o_orderpriority is null) as n from orders
          union all select 'expression.o_totalprice', 'o_totalprice between 1000 and 400000',
                 count(*) filter (not o_totalprice between 1000 and 400000) from orders
          union all select 'allowed.o_orderstatus', 'O, F', count(*) filter (o_orderstatus not in ('O', 'F')) from orders)"""


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    rows = core.rejected_values(staging(spark, d, "attivita_formative_esterne"), "attivita_esterne")
    return rows.select("matricola", "denominazione", "data_attivita", F.array_join("reasons", ",").alias("reasons"))


QUERIES["quality_quarantine"] = _rejected
ORACLE["quality_quarantine"] = sql(
    """select matricola, denominazione, data_attivita, reasons from (
       select *, concat_ws(',',
         case when nullif(trim(ore_dichiarate), '') is not null
               and try_cast(replace(trim(ore_dichiarate), ',', '.') as decimal(10,2)) is null then 'ore_dichiarate' end,
         case when nullif(trim(ore_riconosciute), '') is not null
               and try_cast(replace(trim(ore_riconosciute), ',', '.') as decimal(10,2)) is null then 'ore_riconosciute' end,
         case when try_cast(replace(trim(ore_calcolate), ',', '.') as decimal(10,2)) is null then 'ore_calcolate' end,
         case when try_cast(replace(trim(coeff_voto), ',', '.') as decimal(8,4)) is null then 'coeff_voto' end,
         case when try_cast(replace(trim(punti), ',', '.') as decimal(12,2)) is null then 'punti' end,
         case when try_strptime(trim(data_attivita), '%d/%m/%Y') is null then 'data_attivita' end,
         case when try_strptime(trim(data_convalida), '%d/%m/%Y') is null then 'data_convalida' end) as reasons
       from stg_attivita_formative_esterne) where reasons <> ''""",
    "stg_attivita_formative_esterne",
)
