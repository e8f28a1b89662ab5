"""Ingest and streaming queries: the given tables go out as files and come back in."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import shared_dir
from recordmill.sources.ingest import ingest, manifest
from recordmill.sources.specs import SourceSpec
from recordmill.sources.store import Store
from recordmill.streaming.incremental import events_stream, ingest_stream, keep_new_events
from workload.tables import table

QUERIES, ORACLE = {}, {}

SPEC = SourceSpec(
    "orders", "orders", "cycle=*/*.csv", None,
    {"Key": "key", "Customer": "customer", "Priority (à)": "priority", "Note": "note"},
    path_fields={"cycle": r"/cycle=(\d+)/"}, null_tokens=("", "NA"), drop_marker=("priority", "5-LOW"),
)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _write_orders(spark: SparkSession, d: str, root: str) -> None:
    """All orders as CSV, by year and status; header order and delimiter differ by status."""
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("Key"),
        F.col("o_custkey").alias("Customer"),
        F.col("o_orderpriority").alias("Priority (à)"),
        F.when(F.col("o_orderstatus") == "O", F.lit('said "hi";\nthen, left')).otherwise("NA").alias("Note"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("cycle"),
    )
    layouts = {
        "F": (["Key", "Customer", "Priority (à)", "Note"], ";"),
        "O": (["Note", "Priority (à)", "Customer", "Key"], ","),
        "P": (["Customer", "Key", "Extra", "Priority (à)"], "\t"),
    }
    for status, (columns, sep) in layouts.items():
        part = rows.where(F.col("status") == status).withColumn("Extra", F.lit("x"))
        (
            part.select("cycle", *columns)
            .write.mode("append")
            .partitionBy("cycle")
            .options(header=True, sep=sep, quote='"', escape='"')
            .csv(root)
        )


_EXPECTED = """select cast(year(o_orderdate) as varchar) as cycle, cast(o_orderkey as varchar) as "key",
    cast(o_custkey as varchar) as customer, o_orderpriority as priority,
    case when o_orderstatus = 'O' then 'said "hi";' || chr(10) || 'then, left' end as note
    from orders where o_orderpriority <> '5-LOW'"""


def _ingested(spark: SparkSession, d: str) -> tuple[str, Store, str]:
    root = _scratch(spark)
    _write_orders(spark, d, f"{root}/in")
    store = Store(spark, f"{root}/store")
    return root, store, store.start_run("csv_lane")


def _roundtrip(spark: SparkSession, d: str) -> DataFrame:
    root, store, run_id = _ingested(spark, d)
    ingest(spark, SPEC, f"{root}/in", store, run_id)
    return store.read("staging", "orders").select("cycle", "key", "customer", "priority", "note")


def _twice(spark: SparkSession, d: str) -> DataFrame:
    root, store, run_id = _ingested(spark, d)
    for _ in range(2):
        ingest(spark, SPEC, f"{root}/in", store, run_id)
    rows = store.read("staging", "orders").agg(F.count("*").alias("staged_rows"))
    files = manifest(store).agg(
        F.sum("rows_loaded").cast("bigint").alias("logged_rows"),
        F.count_if(F.col("status") != "LOADED").alias("not_loaded"),
        (F.count("*") - F.count_distinct("file_path")).alias("repeated_files"),
    )
    events = store.read_log("file_manifest").agg((F.count("*") - F.count_distinct("file_path")).alias("extra_events"))
    return rows.join(files).join(events)


QUERIES["ingest_roundtrip"] = _roundtrip
ORACLE["ingest_roundtrip"] = _EXPECTED
QUERIES["ingest_idempotent"] = _twice
ORACLE["ingest_idempotent"] = f"""select count(*) as staged_rows, count(*) as logged_rows, 0 as not_loaded,
    0 as repeated_files, 0 as extra_events from ({_EXPECTED})"""


class Broken(RuntimeError):
    pass


def _recovered(spark: SparkSession, d: str) -> DataFrame:
    """The run dies after the rows are written and before the manifest is; the next run loads every row once."""
    root, store, run_id = _ingested(spark, d)
    write = store.append_log

    def dying(name: str, rows) -> None:
        if name == "file_manifest":
            raise Broken
        write(name, rows)

    store.append_log = dying
    try:
        ingest(spark, SPEC, f"{root}/in", store, run_id)
    except Broken:
        pass
    again = Store(spark, store.root)
    ingest(spark, SPEC, f"{root}/in", again, again.start_run("csv_lane"))
    return again.read("staging", "orders").select("cycle", "key", "customer", "priority", "note")


def _in_many_reads(spark: SparkSession, d: str) -> DataFrame:
    root, store, run_id = _ingested(spark, d)
    ingest(spark, SPEC, f"{root}/in", store, run_id, files_per_read=12)
    return store.read("staging", "orders").select("cycle", "key", "customer", "priority", "note")


QUERIES["ingest_recovered"] = _recovered
ORACLE["ingest_recovered"] = _EXPECTED
QUERIES["ingest_more_files_than_a_read"] = _in_many_reads
ORACLE["ingest_more_files_than_a_read"] = _EXPECTED


TEXTS = SourceSpec(
    "texts", "texts", "*.csv", ",", {"Id": "doc_id", "Language": "lang", "Body": "body"}, null_tokens=()
)


def _quoted_breaks(spark: SparkSession, d: str) -> DataFrame:
    """All texts as delimited files with line breaks and quotes in every row, cut into rows by their splits."""
    root = _scratch(spark)
    breaks = F.concat("text", F.lit('\n"'), "lang", F.lit('";\n, end'))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("Id"), F.col("lang").alias("Language"), breaks.alias("Body"))
    rows.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{root}/in")
    store = Store(spark, f"{root}/store")
    ingest(spark, TEXTS, f"{root}/in", store, store.start_run("csv_lane"))
    return store.read("staging", "texts").select("doc_id", "lang", "body")


QUERIES["ingest_quoted_breaks"] = _quoted_breaks
ORACLE["ingest_quoted_breaks"] = """select cast(doc_id as varchar) as doc_id, lang,
    text || chr(10) || '"' || lang || '";' || chr(10) || ', end' as body from documents"""


def _swallowed_header(spark: SparkSession, d: str) -> DataFrame:
    """Files whose header and rows each came as one quoted field."""
    root = _scratch(spark)
    row = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus"))
    table(spark, d, "orders").select(row.alias("Key;Priority;Status"), F.lit(None).cast("string").alias(" ")).write.options(
        header=True, quoteAll=True
    ).csv(f"{root}/in")
    spec = SourceSpec("swallowed", "swallowed", "*.csv", None, {"Key": "key", "Status": "status", "Priority": "priority"})
    store = Store(spark, f"{root}/store")
    ingest(spark, spec, f"{root}/in", store, store.start_run("csv_lane"))
    return store.read("staging", "swallowed").select("key", "status", "priority")


QUERIES["ingest_swallowed_header"] = _swallowed_header
ORACLE["ingest_swallowed_header"] = """select cast(o_orderkey as varchar) as "key", o_orderstatus as status,
    o_orderpriority as priority from orders"""


def _with_callback(spark: SparkSession, d: str) -> DataFrame:
    """A loader with a transformation of its own: urgent orders only, one row per word of the note."""
    root, store, run_id = _ingested(spark, d)

    def urgent(rows: DataFrame) -> DataFrame:
        words = F.explode_outer(F.split("note", " "))
        return rows.where("priority = '1-URGENT'").withColumn("note", words)

    ingest(spark, replace(SPEC, post=urgent), f"{root}/in", store, run_id)
    return store.read("staging", "orders").select("cycle", "key", "customer", "priority", "note")


QUERIES["ingest_with_callback"] = _with_callback
ORACLE["ingest_with_callback"] = f"""with loaded as ({_EXPECTED})
    select * replace (unnest(case when note is null then [null] else string_split(note, ' ') end) as note)
    from loaded where priority = '1-URGENT'"""


def _upserted_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A composite key that repeats in the new rows: the cheapest line of an order and part stays."""
    store = Store(spark, _scratch(spark))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    keys = ["l_orderkey", "l_partkey"]
    store.upsert("core", "lines", lines.where("l_linenumber = 1"), keys, ["l_linenumber"])
    store.upsert("core", "lines", lines.unionByName(lines).where("l_linenumber > 1"), keys, ["l_linenumber"])
    return store.read("core", "lines")


QUERIES["store_upsert_pairs"] = _upserted_pairs
ORACLE["store_upsert_pairs"] = """select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem
    qualify row_number() over (partition by l_orderkey, l_partkey order by l_linenumber = 1, l_linenumber, l_quantity) = 1"""


def _upserted(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, _scratch(spark))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    store.upsert("core", "orders", orders.where(F.col("o_orderstatus") != "P"), ["o_orderkey"])
    changed = orders.where(F.col("o_orderstatus") != "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    store.upsert("core", "orders", changed, ["o_orderkey"])
    return store.read("core", "orders")


QUERIES["store_upsert"] = _upserted
ORACLE["store_upsert"] = """select o_orderkey, o_custkey, o_orderstatus,
    case when o_orderstatus = 'F' then o_totalprice else -o_totalprice end as o_totalprice from orders"""


def _upserted_few(spark: SparkSession, d: str) -> DataFrame:
    """Few keys change, those of the last day: only their buckets are written again."""
    store = Store(spark, _scratch(spark))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    store.upsert("core", "orders", orders, ["o_orderkey"], buckets=256)
    last = orders.agg(F.max("o_orderdate").alias("o_orderdate"))
    changed = orders.join(last, "o_orderdate").withColumn("o_totalprice", -F.col("o_totalprice"))
    store.upsert("core", "orders", changed, ["o_orderkey"], buckets=256)
    return store.read("core", "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


QUERIES["store_upsert_few"] = _upserted_few
ORACLE["store_upsert_few"] = """select o_orderkey, o_custkey, o_orderdate::varchar as o_orderdate,
    case when o_orderdate = (select max(o_orderdate) from orders) then -o_totalprice else o_totalprice end as o_totalprice
    from orders"""


def _inserted(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, _scratch(spark))
    texts = table(spark, d, "documents").select(F.sha2("text", 256).alias("hash"), "doc_id", "lang")
    store.insert_absent("etl", "texts", texts.where(F.col("lang") == "en"), "hash", ["doc_id"])
    store.insert_absent("etl", "texts", texts, "hash", ["doc_id"])
    return store.read("etl", "texts")


QUERIES["store_insert_absent"] = _inserted
ORACLE["store_insert_absent"] = """select sha256(text) as hash, doc_id, lang from documents
    qualify row_number() over (partition by sha256(text) order by lang = 'en' desc, doc_id) = 1"""


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    root, store, run_id = _ingested(spark, d)
    ingest_stream(spark, SPEC, f"{root}/in", store, run_id, f"{root}/checkpoint", files_per_trigger=40)
    return store.read("staging", "orders").select("cycle", "key", "customer", "priority", "note")


QUERIES["stream_ingest"] = _streamed
ORACLE["stream_ingest"] = _EXPECTED


def _stream_unique(spark: SparkSession, d: str) -> DataFrame:
    """Every event arrives twice, in many batches and in no order of time; one of each is kept."""
    root = _scratch(spark)
    events = table(spark, d, "events")
    for copy in ("a", "b"):
        events.repartition(4, F.xxhash64("event_id", F.lit(copy))).write.mode("append").parquet(f"{root}/in")
    stream = events_stream(spark, f"{root}/in", "*.parquet", events.schema, files_per_trigger=3)
    store = Store(spark, f"{root}/store")
    keep_new_events(stream, store, "staging", "events", ["event_id"], f"{root}/checkpoint")
    return store.read("staging", "events").select("event_id", "user_id", "event_type", "value")


QUERIES["stream_unique_events"] = _stream_unique
ORACLE["stream_unique_events"] = "select distinct event_id, user_id, event_type, value from events"


def _stream_first(spark: SparkSession, d: str) -> DataFrame:
    """The first purchase or error of each user by value; of users without one, the first event that comes later.

    A user's events of one arrival are in one batch, and the stream is started once per arrival."""
    root = _scratch(spark)
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    store = Store(spark, f"{root}/store")
    for arrived in (events.where("event_type in ('purchase', 'error') and value > 20"), events):
        arrived.repartition(6, "user_id").write.mode("append").parquet(f"{root}/in")
        stream = events_stream(spark, f"{root}/in", "*.parquet", events.schema, files_per_trigger=2).drop("ts", "props")
        keep_new_events(stream, store, "staging", "first", ["user_id"], f"{root}/checkpoint", ["value", "event_id"])
    return store.read("staging", "first").select("user_id", "event_id", "event_type", "value")


QUERIES["stream_first_events"] = _stream_first
ORACLE["stream_first_events"] = """with ranked as (
        select user_id, event_id, event_type, value, event_type in ('purchase', 'error') and value > 20 as early from events)
    select user_id, event_id, event_type, value from ranked
    qualify row_number() over (partition by user_id order by early desc, value, event_id, event_type) = 1"""
