"""Incremental ingest and event de-duplication on Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.sources.ingest import _escaped, ingest, manifest
from recordmill.sources.specs import SourceSpec
from recordmill.sources.store import Store

FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    store: Store,
    run_id: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
) -> None:
    """Load all files that arrived since the last call, in batches of files.

    The stream remembers paths; the manifest inside ``ingest`` remembers content, so
    a re-sent copy, or a batch that runs again after a failure, loads nothing twice.
    Files that failed in an earlier run are known to the stream and tried again first.
    """
    failed = manifest(store).where((F.col("source") == spec.name) & (F.col("status") == "FAILED") & (F.col("run_id") != run_id))
    again = [r.file_path for r in failed.select("file_path").distinct().collect()]
    again = [_escaped(p) for p in again if store.exists(p)]
    if again:
        ingest(spark, spec, root, store, run_id, paths=again)
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(f"{root}/{spec.glob}")
        .select("path")
    )

    def load(batch: DataFrame, _: int) -> None:
        paths = [_escaped(r.path) for r in batch.collect()]
        if paths:
            ingest(spark, spec, root, store, run_id, paths=paths)

    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def unique_events(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the delay; state older than it is let go.

    Events that come later than the delay are dropped by the watermark. Where every event counts, take
    ``keep_new_events``.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def first_of_each(stream: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows of a stream whose key did not come before, however long ago; null is a key as well.

    Keys live in the state store, so a batch costs its own rows and not those stored before. Without ``order`` one row
    of the batch that brings a key is kept, and the state holds keys only. With ``order`` it is the first row by these
    columns, nulls last, then by the others; the state then holds the kept rows too. Such a stream is written in
    update mode.
    """
    if not order:
        return stream.dropDuplicates(list(keys))
    rest = [c for c in stream.columns if c not in {*keys, *order}]
    by = [x for c in (*order, *rest) for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    # the time of a batch is one value, and the same when the batch runs again
    timed = stream.withColumn("__at", F.current_timestamp())
    first = F.min(F.struct(*by)).alias("__row")
    seen = timed.groupBy(*keys).agg(first, F.min("__at").alias("__first"), F.max("__at").alias("__last"))
    return seen.where("__first = __last").select(*[c if c in keys else F.col(f"__row.{c}") for c in stream.columns])


def keep_new_events(
    stream: DataFrame, store: Store, layer: str, table: str, keys: Sequence[str], checkpoint: str, order: Sequence[str] = ()
) -> None:
    """Append what is available now to a table, each key once, however late it comes and whatever its time.

    See ``first_of_each`` for which row of a key is kept. The checkpoint holds the keys, so a table keeps its own; the
    number of state partitions is the session's number of shuffle partitions at its first use. A batch is a part with
    a name of its own: one that runs again after a failure writes the same part again, or nothing if it was seen before.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def keep(batch: DataFrame, number: int) -> None:
        part = f"{name}-{number}"
        if store.has_part(layer, table, part):
            # its keys must enter the state all the same
            batch.write.format("noop").mode("overwrite").save()
        else:
            store.append(layer, table, batch, part)

    writer = first_of_each(stream, keys, order).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    query = writer.outputMode("update" if order else "append").trigger(availableNow=True).start()
    query.awaitTermination()


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write what is available now as Parquet and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def events_stream(spark: SparkSession, folder: str, file_name: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of one name in a folder, as a stream with typed event time."""
    options = {"pathGlobFilter": file_name, "maxFilesPerTrigger": files_per_trigger}
    raw = spark.readStream.schema(schema).options(**options).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))
