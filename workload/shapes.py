"""Row-shape and key operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions import clean
from recordmill.functions.keys import surrogate_key, text_hash
from recordmill.operators.dedup import keep_first, keep_latest
from recordmill.operators.lists import text_list
from recordmill.operators.reshape import drop_marker, explode_list, unpivot_years, years_to_rows
from recordmill.operators.resolve import exclude_by_initial, fill_id_by_unique_name
from workload.oracle import METRICS, YEARS, sql
from workload.staging import staging
from workload.tables import table

QUERIES, ORACLE = {}, {}


def _keep_latest_line(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


QUERIES["keep_latest_line"] = _keep_latest_line
ORACLE["keep_latest_line"] = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey, l_suppkey) = 1"""

QUERIES["keep_latest_event"] = lambda spark, d: keep_first(
    table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value"),
    ["user_id", "event_type"],
    [F.col("ts").desc_nulls_last(), F.col("event_id").asc()],
)
ORACLE["keep_latest_event"] = """
    select user_id, event_type, ts, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc nulls last, event_id) = 1"""

QUERIES["explode_names"] = lambda spark, d: explode_list(
    table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "SMALL", F.lit(None)).otherwise(F.replace("p_name", F.lit(" "), F.lit(" ; "))).alias("words"),
    ),
    "words",
    ";",
)
ORACLE["explode_names"] = """
    select p_partkey, trim(unnest(string_split(replace(p_name, ' ', ' ; '), ';'))) as words from part where p_type <> 'SMALL'
    union all select p_partkey, null from part where p_type = 'SMALL'"""

QUERIES["distinct_rows"] = lambda spark, d: (
    table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()
)
ORACLE["distinct_rows"] = "select distinct l_partkey, l_suppkey, l_returnflag from lineitem"

QUERIES["drop_marker_rows"] = lambda spark, d: drop_marker(
    table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority")
    ),
    "priority",
    "5-LOW",
)
ORACLE["drop_marker_rows"] = """
    select o_orderkey, nullif(o_orderpriority, '1-URGENT') as priority from orders where o_orderpriority <> '5-LOW'"""


def _wide(spark: SparkSession, d: str) -> DataFrame:
    from recordmill.plans import core

    return core.filtered_iu_stats(staging(spark, d, "filtered_iu_stats")).drop("id")


QUERIES["unpivot_years"] = lambda spark, d: unpivot_years(
    _wide(spark, d), ["cod_ins", "nome_insegnamento", "docente"]
)
ORACLE["unpivot_years"] = sql(
    " union all ".join(
        f"select cod_ins, nome_insegnamento, docente, '{m}' as metric, {y} as anno, {m}_{y} as value "
        "from core_filtered_iu_stats"
        for y in YEARS
        for m in METRICS
    ),
    "core_filtered_iu_stats",
)
QUERIES["years_to_rows"] = lambda spark, d: years_to_rows(_wide(spark, d), ["cod_ins", "nome_insegnamento", "docente"])
ORACLE["years_to_rows"] = sql(
    " union all ".join(
        f"select cod_ins, nome_insegnamento, docente, {y} as anno, iscritti_{y} as iscritti, superati_{y} as superati, "
        f"iis_iscritti_{y} as iis_iscritti, iis_superati_{y} as iis_superati from core_filtered_iu_stats"
        for y in (2022, 2023, 2024, 2025)
    ),
    "core_filtered_iu_stats",
)


def _clean_text(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    padded = F.when(F.col("c_acctbal") < 0, "   ").otherwise(F.concat(F.lit("  "), "c_mktsegment", F.lit("  ")))
    raw = c.select("c_custkey", padded.alias("raw"), "c_name", "c_mktsegment")
    return raw.select(
        "c_custkey",
        clean.blank_to_null("raw").alias("text"),
        clean.lower_text("raw").alias("lower_text"),
        F.coalesce(clean.blank_to_null("raw"), F.lit("missing")).alias("with_default"),
        clean.name_key(F.concat(F.lit(" "), "raw", F.lit("  X"))).alias("name_key"),
        clean.nth_part("c_name", "#", 2).alias("second_part"),
        clean.nth_part("c_name", "#", 3).alias("third_part"),
        clean.first_initial(F.concat(F.lit("."), "c_mktsegment")).alias("initial"),
        F.concat(clean.blank_to_null("raw"), F.lit("!")).alias("strict_text"),
        clean.text_of_all(clean.blank_to_null("raw"), F.lit("!")).alias("loose_text"),
        text_hash("raw").alias("hash"),
    )


QUERIES["clean_text"] = _clean_text
ORACLE["clean_text"] = """
    select c_custkey, nullif(trim(raw), '') as text, nullif(lower(trim(raw)), '') as lower_text,
           coalesce(nullif(trim(raw), ''), 'missing') as with_default,
           lower(regexp_replace(trim(' ' || raw || '  X'), '\\s+', ' ', 'g')) as name_key,
           split_part(c_name, '#', 2) as second_part, split_part(c_name, '#', 3) as third_part,
           left(c_mktsegment, 1) as initial, nullif(trim(raw), '') || '!' as strict_text,
           concat(nullif(trim(raw), ''), '!') as loose_text, sha256(raw) as hash
    from (select *, case when c_acctbal < 0 then '   ' else '  ' || c_mktsegment || '  ' end as raw from customer)"""

QUERIES["surrogate_keys"] = lambda spark, d: table(spark, d, "lineitem").select(
    "l_orderkey", "l_linenumber",
    surrogate_key(["l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")),
                   F.col("l_quantity").cast("decimal(10,2)"), F.col("l_shipdate").cast("date")]).alias("id"),
)
ORACLE["surrogate_keys"] = """
    select l_orderkey, l_linenumber, md5(concat_ws(chr(31), cast(l_orderkey as varchar), cast(l_linenumber as varchar),
           coalesce(nullif(l_returnflag, 'N'), chr(30) || 'null'), cast(cast(l_quantity as decimal(10,2)) as varchar),
           cast(cast(l_shipdate as date) as varchar))) as id from lineitem"""


def _unique_name(spark: SparkSession, d: str) -> DataFrame:
    """Ids of lines whose part is known only by name and price, where that names one part."""
    parts = table(spark, d, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price")
    )
    lines = (
        table(spark, d, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.upper("p_name").alias("p_name"),
            F.concat(F.lit(" "), "price").alias("price"),
            F.when(F.col("l_returnflag") == "A", F.col("l_partkey")).alias("part_id"),
        )
    )
    return fill_id_by_unique_name(lines, parts, "p_partkey", ["p_name", "price"], "part_id", "candidates")


QUERIES["unique_name_fill"] = _unique_name
ORACLE["unique_name_fill"] = """
    with p as (select *, cast(cast(p_retailprice as decimal(10,2)) as varchar) as price from part),
    n as (select p_name, price, count(*) as cnt, min(p_partkey) as one from p group by 1, 2)
    select l_orderkey, l_linenumber, upper(p.p_name) as p_name, ' ' || p.price as price,
           case when l_returnflag = 'A' then l_partkey when cnt = 1 then one end as part_id, cnt as candidates
    from lineitem join p on l_partkey = p_partkey join n on n.p_name = p.p_name and n.price = p.price"""


def _outsiders(spark: SparkSession, d: str) -> DataFrame:
    def people(t: str, prefix: str) -> DataFrame:
        digits = F.right(f"{prefix}_name", F.lit(2))
        return table(spark, d, t).select(
            F.col(f"{prefix}_name").alias("name"),
            F.concat(F.lit(" N"), F.col(f"{prefix}_nationkey").cast("string"), digits).alias("surname"),
            F.concat(F.lit("."), F.substring(digits, 1, 1)).alias("given"),
        )

    return exclude_by_initial(people("supplier", "s"), "surname", "given", people("customer", "c"), "surname", "given")


QUERIES["exclude_by_initial"] = _outsiders
ORACLE["exclude_by_initial"] = """
    select s_name as name, ' N' || cast(s_nationkey as varchar) || right(s_name, 2) as surname,
           '.' || left(right(s_name, 2), 1) as given
    from supplier where not exists (select 1 from customer where c_nationkey = s_nationkey and right(c_name, 2) = right(s_name, 2))"""


def _hot_list(spark: SparkSession, d: str) -> DataFrame:
    """A third of all order lines on one key: its list is made in ranges by many tasks."""
    lines = table(spark, d, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_suppkey")).alias("supplier"), "l_quantity", "l_shipdate",
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line"),
    )
    total = F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    return text_list(lines, ["supplier"], F.col("line"), [F.col("l_shipdate")], "; ", "lines", [total], ranges=64)


QUERIES["list_hot_group"] = _hot_list
ORACLE["list_hot_group"] = """
    select case when l_orderkey % 3 <> 0 then l_suppkey end as supplier, sum(l_quantity::bigint)::bigint as quantity,
           string_agg(l_orderkey || '-' || l_linenumber, '; ' order by l_shipdate, l_orderkey || '-' || l_linenumber) as lines
    from lineitem group by 1"""
