"""Layered Parquet storage with committed versions, append-only logs and keyed upserts.

Layout: ``<root>/<layer>/<table>/<part>``. A write becomes visible when its row is
appended to the ``commits`` log; a job that dies before leaves only an unread folder.
A table is its last ``replace`` part and the ``append`` parts after it. An upserted table lies in buckets of its key,
``<part>/upsert_bucket=<k>-of-<n>``, each a part of its own; of a bucket the newest ``bucket`` part counts. A ``file_append``
part counts once an event of the file manifest names it, so loaded rows and the manifest
become visible together. One writer at a time is assumed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators.dedup import keep_first

# Names and columns of the control tables.
LOGS = {
    "commits": "layer string, table_name string, kind string, part string, committed_at timestamp",
    "runs": "run_id string, pipeline_name string, triggered_by string, started_at timestamp, "
    "finished_at timestamp, status string, error_message string, logged_at timestamp",
    "file_manifest": "run_id string, source_type string, source string, file_path string, file_name string, "
    "file_keys string, file_hash_sha256 string, file_size_bytes bigint, detected_at timestamp, status string, "
    "rows_loaded bigint, error_message string, modified_at timestamp, part string",
    "step_metrics": "run_id string, step_name string, started_at timestamp, finished_at timestamp, "
    "duration_ms bigint, rows_in bigint, rows_out bigint, status string, message string",
    "validation_results": "run_id string, object_name string, check_name string, status string, "
    "observed_value bigint, expected_value bigint, details string, created_at timestamp",
    "llm_calls": "run_id string, document_id string, model string, prompt_version string, "
    "input_hash_sha256 string, parameters string, status string, error_message string, started_at timestamp, "
    "ended_at timestamp, latency_ms bigint, response_text string, response_json string, validated boolean, "
    "validation_errors string",
}


# Logs with a row per document: written by many tasks, and seen whole by one row of the commits.
WIDE_LOGS = ("llm_calls",)


BUCKETS = 64  # of an upserted table, unless the caller says otherwise
BUCKET_OF = "upsert_bucket"


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- logs -----------------------------------------------------------------

    def _log_path(self, name: str) -> str:
        return f"{self.root}/etl/{name}"

    def append_log(self, name: str, rows: DataFrame | Sequence[tuple]) -> None:
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame(list(rows), LOGS[name])
        columns = [f.split()[0] for f in LOGS[name].split(", ")]
        if name in WIDE_LOGS:
            self.append("etl", name, rows.select(*columns))
            return
        # one file, so that a log write is seen whole or not at all
        rows.select(*columns).coalesce(1).write.mode("append").parquet(self._log_path(name))

    def read_log(self, name: str) -> DataFrame:
        if name in WIDE_LOGS:
            return self.read("etl", name, LOGS[name])
        if not self.exists(self._log_path(name)):
            return self.spark.createDataFrame([], LOGS[name])
        return self.spark.read.schema(LOGS[name]).parquet(self._log_path(name))

    def exists(self, path: str) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    # --- tables ---------------------------------------------------------------

    def commit(self, layer: str, table: str, kind: str, *parts: str) -> None:
        """Make parts visible, all at once."""
        stamp = now()
        self.append_log("commits", [(layer, table, kind, part, stamp) for part in parts])

    def _parts(self, layer: str, table: str) -> list[str]:
        """Visible parts of a table: one row per write since the last full refresh."""
        log = self.read_log("commits").where((F.col("layer") == layer) & (F.col("table_name") == table))
        last = log.where(F.col("kind") == "replace").agg(F.max("committed_at").alias("last")).scalar()
        log = log.where(F.coalesce(F.col("committed_at") >= last, F.lit(True)))
        rows = log.orderBy("committed_at", "part").select("kind", "part").collect()
        # later parts of a bucket take the place of earlier ones; the driver holds one row per bucket and write
        newest = {r.part.split("/")[1]: r.part for r in rows if "/" in r.part}
        rows = [r for r in rows if "/" not in r.part or newest[r.part.split("/")[1]] == r.part]
        if any(r.kind == "file_append" for r in rows):
            named = self.read_log("file_manifest").where(F.col("part").isNotNull()).select("part").distinct()
            loaded = {r.part for r in log.join(named, "part", "left_semi").select("part").collect()}
            rows = [r for r in rows if r.kind != "file_append" or r.part in loaded]
        return [r.part for r in rows]

    def has_part(self, layer: str, table: str, part: str) -> bool:
        """Whether a part of this name was made visible."""
        log = self.read_log("commits").where((F.col("layer") == layer) & (F.col("table_name") == table))
        return not log.where(F.col("part") == part).isEmpty()

    def _write(self, layer: str, table: str, df: DataFrame, kind: str, part: str | None) -> str:
        part = part or uuid.uuid4().hex
        self.write_part(layer, table, df, part)
        self.commit(layer, table, kind, part)
        return part

    def write_part(self, layer: str, table: str, df: DataFrame, part: str) -> None:
        """Write a part without making it visible."""
        df.write.mode("overwrite").parquet(f"{self.root}/{layer}/{table}/{part}")

    def append(self, layer: str, table: str, df: DataFrame, part: str | None = None) -> str:
        return self._write(layer, table, df, "append", part)

    def replace(self, layer: str, table: str, df: DataFrame) -> str:
        """Full refresh: a new version beside the old one, then the switch."""
        return self._write(layer, table, df, "replace", None)

    def read(self, layer: str, table: str, schema: str | None = None) -> DataFrame | None:
        parts = self._parts(layer, table)
        if not parts:
            return self.spark.createDataFrame([], schema) if schema else None
        return self.read_parts(layer, table, parts)

    def read_parts(self, layer: str, table: str, parts: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{layer}/{table}/{p}" for p in parts])

    def upsert(
        self, layer: str, table: str, new: DataFrame, keys: Sequence[str], order: Sequence[str] = (), buckets: int = BUCKETS
    ) -> None:
        """Rows of ``new`` replace rows with the same key; of equal keys in ``new`` the first in ``order``, nulls last,
        then by the remaining columns.

        The table lies in ``buckets`` hash buckets of its key, one file each, so choose their number such that a bucket
        fits a task. Only buckets that ``new`` meets are read and written again. The whole table is laid out anew when
        it is not in these buckets: at the first upsert, after ``replace`` or ``append``, with another number of
        buckets or other columns.
        """
        rest = [c for c in new.columns if c not in {*keys, *order}]
        new = keep_first(new, list(keys), [F.col(c).asc_nulls_last() for c in (*order, *rest)])
        parts = self._parts(layer, table)
        met = self._write_buckets(layer, table, new, keys, buckets)
        if not parts:
            if met:
                self.commit(layer, table, "replace", *met)
            else:
                self.replace(layer, table, new)
            return
        if not met:
            return
        # from here on the new rows are those that were stored, so that they are computed once
        old, new = self.read_parts(layer, table, parts), self.read_parts(layer, table, met)
        if not _laid_out(parts, buckets) or sorted(old.dtypes) != sorted(new.dtypes):
            met = self._write_buckets(layer, table, merged(old, new, keys), keys, buckets)
            self.commit(layer, table, "replace", *met)
            return
        names = {p.split("/")[1] for p in met}
        touched = [p for p in parts if p.split("/")[1] in names]
        if touched:
            rows = merged(self.read_parts(layer, table, touched), new, keys)
            met = self._write_buckets(layer, table, rows, keys, buckets)
        self.commit(layer, table, "bucket", *met)

    def _write_buckets(self, layer: str, table: str, rows: DataFrame, keys: Sequence[str], buckets: int) -> list[str]:
        """Write rows by bucket, one file each, without making them visible; the parts that have rows, a bucket each."""
        part = uuid.uuid4().hex
        path = f"{self.root}/{layer}/{table}/{part}"
        rows = rows.withColumn(BUCKET_OF, _bucket(rows, keys, buckets))
        rows.repartition(buckets, BUCKET_OF).write.partitionBy(BUCKET_OF).parquet(path)
        met = self.spark.read.schema(rows.schema).parquet(path).select(BUCKET_OF).distinct().collect()  # at most ``buckets``
        return sorted(f"{part}/{BUCKET_OF}={r[0]}" for r in met)

    def insert_absent(
        self, layer: str, table: str, new: DataFrame, key: str | Sequence[str], order: Sequence[str]
    ) -> None:
        """Append rows whose key is not there yet; of equal keys in ``new`` the first in order."""
        keys = [key] if isinstance(key, str) else list(key)
        fresh = keep_first(new, keys, [F.col(c).asc_nulls_last() for c in order])
        old = self.read(layer, table)
        self.append(layer, table, fresh if old is None else fresh.join(old.select(*keys), keys, "left_anti"))

    # --- runs and steps -------------------------------------------------------

    def start_run(self, name: str, triggered_by: str = "manual") -> str:
        run_id = str(uuid.uuid4())
        stamp = now()
        self.append_log("runs", [(run_id, name, triggered_by, stamp, None, "RUNNING", None, stamp)])
        return run_id

    def finish_run(self, run_id: str, status: str, error: str | None = None) -> None:
        stamp = now()
        self.append_log("runs", [(run_id, None, None, None, stamp, status, error, stamp)])

    def runs(self) -> DataFrame:
        """One row per run, from its start and finish events."""
        latest = F.max_by("status", "logged_at").alias("status")
        shown = [F.max(c).alias(c) for c in ("pipeline_name", "triggered_by", "started_at", "finished_at")]
        return self.read_log("runs").groupBy("run_id").agg(*shown, latest, F.max("error_message").alias("error_message"))

    @contextmanager
    def step(self, run_id: str, name: str) -> Iterator[dict]:
        """Record duration, row counts and outcome of a step.

        The body sets ``rows_in``, ``rows_out`` and ``message`` in the yielded dict.
        """
        started, clock = now(), time.monotonic()
        facts: dict = {"rows_in": None, "rows_out": None, "message": None}
        status = "SUCCESS"
        try:
            yield facts
        except Exception as error:
            status, facts["message"] = "FAILED", str(error)
            raise
        finally:
            took = int((time.monotonic() - clock) * 1000)
            row = (run_id, name, started, now(), took, facts["rows_in"], facts["rows_out"], status, facts["message"])
            self.append_log("step_metrics", [row])


def _bucket(rows: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row by its key, with the number of buckets: ``17-of-64``."""
    number = F.pmod(F.xxhash64(*[rows[k] for k in keys]), F.lit(buckets))
    return F.concat(number.cast("string"), F.lit(f"-of-{buckets}"))


def _laid_out(parts: Sequence[str], buckets: int) -> bool:
    return all("/" in p and p.endswith(f"-of-{buckets}") for p in parts)


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` without the keys of ``new``, and ``new``.

    The old rows are only probed, not regrouped; with few new keys the probe side is
    broadcast by the planner and the old table does not move.
    """
    fresh = new.select(*keys).distinct()
    return old.join(fresh, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)
