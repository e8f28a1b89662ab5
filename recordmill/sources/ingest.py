"""Idempotent ingest of delimited files into staging.

1. List the files; leave out those that are settled with this path, size and time.
2. Fingerprint the rest by their lines, in splits: hash, header line, empty-marker flag.
   Skip files whose content is already loaded (anti join with the manifest).
3. Read what is left, one read per header line: Spark maps CSV columns by position, so
   only files with the same header may share a read. Files with line breaks in quotes are
   cut into rows first, split by split.
4. Map headers to columns by name, stamp lineage, write, and log one event per file. The
   events make the written rows visible, so rows and manifest cannot disagree.
"""

from __future__ import annotations

import csv
import re
import unicodedata
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.operators.dedup import keep_first
from recordmill.operators.reshape import drop_marker, explode_list
from recordmill.sources.specs import SourceSpec
from recordmill.sources.splits import digests, lines_of, plain_path, quoted_rows, without_scheme, written
from recordmill.sources.store import Store, now

# Files whose names the driver holds at a time, and their bytes: with 128 MiB a split, some 100,000 splits. All files
# are taken, so many by so many.
FILES_PER_READ = 50_000
BYTES_PER_READ = 8 << 40
# Groups of one header line that are read at the same time.
GROUPS_AT_A_TIME = 4
DELIMITERS = (";", "\t", ",")
CORRUPT = "__raw_line"


def _odd_quotes(line: Column) -> Column:
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.contains(line, F.lit('"')) & (quotes % 2 == 1)


def _clean_header(line: Column) -> Column:
    return F.regexp_replace(line, r"^\x{FEFF}|\r\z", "")


LISTING = "file_path string, file_size_bytes bigint, modified_at timestamp"
FACTS = "file_path string, file_size_bytes bigint, file_hash_sha256 string, header string, is_empty boolean, multiline boolean"


def listing(spark: SparkSession, spec: SourceSpec, paths: str | Sequence[str]) -> DataFrame:
    """Path, size and time of the matching files; no content is read."""
    try:
        files = spark.read.format("binaryFile").load(paths)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LISTING)
    found = files.select(
        without_scheme(F.col("path")).alias("file_path"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )
    return found.where(~F.col("file_path").rlike(spec.exclude)) if spec.exclude else found


def fingerprint(spark: SparkSession, spec: SourceSpec, paths: str | Sequence[str]) -> DataFrame:
    """One row per matching file, whatever its size.

    The hash is the SHA-256 of the file's size and the root of a hash tree over its bytes, in blocks that do not
    depend on how the file is split; no file is held as one value.
    """
    files = listing(spark, spec, paths).drop("modified_at")
    if not files.columns or files.isEmpty():
        return _with_names(spark.createDataFrame([], FACTS), spec)
    # sums and flags only, so that lines are grouped by hash, without a sort; the first line comes with the digest
    splits = lines_of(spark, paths).groupBy("file_path", "block").agg(
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("n_bytes"),
        F.bool_or(F.contains(F.lower("value"), F.lit(spec.empty_marker.lower()))).alias("marked"),
        F.bool_or(_odd_quotes(F.col("value"))).alias("odd"),
    )
    splits = written(splits, "facts")
    whole = splits.groupBy("file_path").agg(F.bool_or("marked").alias("marked"), F.bool_or("odd").alias("odd"))
    content = F.concat_ws(":", F.col("file_size_bytes").cast("string"), F.coalesce("tree", F.lit("")))
    found = files.join(whole, "file_path", "left").join(digests(spark, paths, splits), "file_path", "left").select(
        "file_path", "file_size_bytes",
        F.sha2(content, 256).alias("file_hash_sha256"),
        _clean_header(F.coalesce("line", F.lit(""))).alias("header"),
        F.coalesce("marked", F.lit(False)).alias("is_empty"),
        F.coalesce("odd", F.lit(False)).alias("multiline"),
    )
    return _with_names(found, spec)


def path_field(path: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def _with_names(files: DataFrame, spec: SourceSpec) -> DataFrame:
    keys = [path_field(F.col("file_path"), p).alias(n) for n, p in spec.path_fields.items()]
    return files.select(
        "*",
        F.substring_index("file_path", "/", -1).alias("file_name"),
        (F.to_json(F.struct(*keys)) if keys else F.lit("{}")).alias("file_keys"),
        F.lit(spec.name).alias("source"),
    )


def _identity(scope: str) -> list[str]:
    """Columns that make a file "the same": its source, its path keys and its content,
    or, with global scope, its content alone."""
    return ["file_hash_sha256"] if scope == "global" else ["source", "file_keys", "file_hash_sha256"]


def manifest(store: Store, scope: str = "keys") -> DataFrame:
    """Latest event per file content."""
    return keep_first(
        store.read_log("file_manifest"), _identity(scope), [F.desc("detected_at"), F.desc("run_id"), F.desc("file_path")]
    )


def unseen(files: DataFrame, spec: SourceSpec, store: Store) -> DataFrame:
    """Listed files without a LOADED or SKIPPED event of the same path, size and time."""
    same = ["file_path", "file_size_bytes", "modified_at"]
    done = store.read_log("file_manifest").where((F.col("source") == spec.name) & F.col("status").isin("LOADED", "SKIPPED"))
    return files.join(done.select(*same).distinct(), same, "left_anti")


def new_files(files: DataFrame, store: Store, scope: str = "keys") -> DataFrame:
    """Files to load: content not yet LOADED or SKIPPED, first path of equal content."""
    done = manifest(store, scope).where(F.col("status").isin("LOADED", "SKIPPED")).select(*_identity(scope))
    return keep_first(files.join(done, _identity(scope), "left_anti"), _identity(scope), [F.col("file_path").asc()])


def delimiter_of(header: str) -> str:
    """The delimiter that splits a header line best; the first of equals."""
    return max(DELIMITERS, key=lambda d: len(next(csv.reader([header], delimiter=d), [])))


def header_names(header: str, delimiter: str) -> list[str]:
    """Normalised header names; a line quoted as a whole is split once more."""
    names = next(csv.reader([header], delimiter=delimiter), [])
    filled = [n for n in names if n.strip()]
    if len(filled) == 1 and delimiter != ";" and ";" in filled[0]:
        names = next(csv.reader([filled[0]], delimiter=";"), [])
    return [unicodedata.normalize("NFC", n.strip().strip('"')) for n in names]


def _swallowed(header: str, delimiter: str) -> bool:
    """The header came as one quoted field, ``"a;b;c",,,``: rows are split inside it."""
    names = next(csv.reader([header], delimiter=delimiter), [])
    filled = [n for n in names if n.strip()]
    return len(filled) == 1 and delimiter != ";" and ";" in filled[0]


def _escaped(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_group(
    spark: SparkSession, spec: SourceSpec, paths: Sequence[str], header: str, multiline: bool
) -> tuple[DataFrame, DataFrame, Observation]:
    """Files with one header line: rows by column name, rows longer than the header,
    and the number of the latter, known once the former are written."""
    delimiter = spec.separator or delimiter_of(header)
    names = header_names(header, delimiter)
    if spec.separator is None and _swallowed(header, delimiter):
        return _read_swallowed(spark, spec, paths, names, delimiter)
    positions = [f"c{i}" for i in range(len(names))]
    if multiline:
        return _read_quoted(spark, spec, paths, names, positions, delimiter)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*positions, CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .options(sep=delimiter, header=True, quote='"', escape='"', mode="PERMISSIVE",
                 columnNameOfCorruptRecord=CORRUPT, columnPruning=False, encoding="UTF-8")
        .csv([_escaped(p) for p in paths])
        .withColumn("source_file", plain_path(F.col("_metadata.file_path")))
    )
    # Spark flags short and long rows alike; one more field tells them apart.
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    again = F.from_csv(F.col(CORRUPT), F.lit(wider), {"sep": delimiter, "quote": '"', "escape": '"'})
    too_long = F.col(CORRUPT).isNotNull() & again.getField(f"c{len(names)}").isNotNull()
    flagged = rows.withColumn("__long", F.coalesce(too_long, F.lit(False)))
    return _split_long(flagged, F.col(CORRUPT), spec, names, positions)


def _read_quoted(spark, spec, paths, names, positions, delimiter):
    """Rows with line breaks in quotes: cut by all tasks, then parsed one by one."""
    rows = quoted_rows(spark, paths, delimiter, [_escaped(p) for p in paths])
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true"}
    fields = rows.withColumn("__row", F.from_csv("text", F.lit(wider), options)).select("source_file", "text", "__row.*")
    flagged = fields.withColumn("__long", F.col(f"c{len(names)}").isNotNull())
    return _split_long(flagged, F.col("text"), spec, names, positions)


def _split_long(flagged, raw, spec, names, positions):
    seen = Observation()
    watched = flagged.observe(seen, F.count_if("__long").alias("long"))
    good = _named(watched.where(~F.col("__long")), spec, names, positions)
    # Spark refuses a CSV query of the raw line alone, so a second column goes with it.
    long_rows = flagged.where("__long").select("source_file", F.coalesce(raw, F.col(positions[0])).alias("raw_line"))
    return good, long_rows, seen


def _read_swallowed(spark, spec, paths, names, delimiter):
    rows = (
        spark.read.schema("c0 string").options(sep=delimiter, header=True, quote='"', escape='"')
        .csv([_escaped(p) for p in paths])
        .withColumn("source_file", plain_path(F.col("_metadata.file_path")))
        .withColumn("__fields", F.split(F.coalesce("c0", F.lit("")), ";"))
    )
    positions = [f"c{i}" for i in range(len(names))]
    split = rows.select("source_file", "__fields", *[F.get("__fields", F.lit(i)).alias(c) for i, c in enumerate(positions)])
    flagged = split.withColumn("__long", F.size("__fields") > len(names))
    return _split_long(flagged, F.array_join("__fields", ";"), spec, names, positions)


def _named(rows: DataFrame, spec: SourceSpec, names: list[str], positions: list[str]) -> DataFrame:
    def value(header: str) -> Column:
        wanted = unicodedata.normalize("NFC", header)
        if wanted not in names:
            return F.lit(None).cast("string")
        column = F.col(positions[names.index(wanted)])
        return F.when(~column.isin(*spec.null_tokens), column) if spec.null_tokens else column

    return rows.select("source_file", *[value(h).alias(c) for h, c in spec.columns.items()])


def staged(rows: DataFrame, spec: SourceSpec, run_id: str, loaded_at: datetime) -> DataFrame:
    """Row filter, explode, keys from the path and lineage."""
    if spec.drop_marker:
        rows = drop_marker(rows, *spec.drop_marker)
    if spec.explode:
        rows = explode_list(rows, *spec.explode)
    if spec.post:
        rows = spec.post(rows)
    return rows.select(
        F.lit(run_id).alias("run_id"),
        "source_file",
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
        *[path_field(F.col("source_file"), p).alias(n) for n, p in spec.path_fields.items()],
        *spec.columns.values(),
    )


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    store: Store,
    run_id: str,
    paths: Sequence[str] | None = None,
    scope: str = "keys",
    files_per_read: int = FILES_PER_READ,
) -> DataFrame:
    """Load all new files of one source; returns their manifest events.

    A file that cannot be loaded is logged as FAILED and tried again next time; it does not stop the others. The
    driver holds the names of about ``files_per_read`` files at a time. Rows are written first; the events, written
    last in one file, make them visible, so a run that dies in between leaves nothing that is read.
    """
    stamp = now()
    fresh = unseen(listing(spark, spec, paths or f"{root}/{spec.glob}"), spec, store)
    work = f"{store.root}/etl/listed/{run_id}-{spec.name}-{stamp:%H%M%S%f}"
    fresh.write.parquet(work)
    fresh = spark.read.schema(LISTING).parquet(work)
    n, size = fresh.agg(F.count("*"), F.coalesce(F.sum("file_size_bytes"), F.lit(0))).first()
    reads = max(-(-n // files_per_read), -(-size // BYTES_PER_READ))
    for i in range(reads):
        some = fresh.where(F.pmod(F.xxhash64("file_path"), F.lit(reads)) == i)
        _load(spark, spec, store, run_id, stamp, some, scope, i)
    log = store.read_log("file_manifest")
    return log.where((F.col("run_id") == run_id) & (F.col("source") == spec.name) & (F.col("detected_at") == F.lit(stamp)))


def _load(spark, spec, store, run_id, stamp, listed: DataFrame, scope: str, read: int) -> None:
    """Load some listed files: write their rows, then their events."""
    names = [_escaped(r.file_path) for r in listed.select("file_path").collect()]
    if not names:
        return
    todo = new_files(fingerprint(spark, spec, names), store, scope).join(listed.select("file_path", "modified_at"), "file_path")
    found = todo.select(
        "file_path", "file_name", "file_keys", "file_hash_sha256", "file_size_bytes", "modified_at", "header", "is_empty", "multiline"
    ).orderBy("file_path").collect()
    if not found:
        return

    outcome: dict[str, tuple[str, str | None, str | None]] = {}
    groups: dict[tuple[str, bool], list[str]] = {}
    for f in found:
        if f.is_empty:
            outcome[f.file_path] = ("SKIPPED", "Empty marker detected", None)
            continue
        if not (f.header or "").strip():
            outcome[f.file_path] = ("FAILED", "No header line", None)
            continue
        names = header_names(f.header, spec.separator or delimiter_of(f.header))
        missing = [h for h in spec.must_have if unicodedata.normalize("NFC", h) not in names]
        if missing:
            outcome[f.file_path] = ("FAILED", f"Missing columns: {missing}", None)
            continue
        groups.setdefault((f.header, f.multiline), []).append(f.file_path)

    def load(number: int, header: str, multiline: bool, group: list[str]) -> tuple[str | None, bool, str | None]:
        """Write the rows of a group; its part, whether rows of it were put aside, and its error."""
        part = f"{run_id}-{spec.name}-{stamp:%H%M%S%f}-{read}-{number}"
        try:
            good, long_rows, seen = read_group(spark, spec, group, header, multiline)
            store.write_part("staging", spec.table, staged(good, spec, run_id, stamp), part)
            aside = bool(seen.get["long"])
            if aside:
                store.write_part("quarantine", spec.table, _quarantined(long_rows, run_id, stamp), part)
            return part, aside, None
        except Exception as error:  # noqa: BLE001 - one bad group must not stop the run
            return None, False, str(error)

    # a group is a few jobs one after another, so several groups at a time fill the executors
    ordered = [(i, *key, group) for i, (key, group) in enumerate(sorted(groups.items()))]
    with ThreadPoolExecutor(GROUPS_AT_A_TIME) as pool:
        written_parts = list(pool.map(lambda g: load(*g), ordered))
    for (*_, group), (part, _, error) in zip(ordered, written_parts):
        outcome.update({p: ("FAILED", error, None) if part is None else ("LOADED", None, part) for p in group})
    parts = [part for part, _, _ in written_parts if part]
    # parts count only once the manifest names them
    if aside := [part for part, long, _ in written_parts if long]:
        store.commit("quarantine", spec.table, "file_append", *aside)
    if parts:
        store.commit("staging", spec.table, "file_append", *parts)

    loaded = _rows_per_file(store, spec, parts)
    store.append_log("file_manifest", _events(spark, found, outcome, loaded, spec, run_id, stamp))


def _quarantined(rows: DataFrame, run_id: str, stamp: datetime) -> DataFrame:
    """The rows that could not be read."""
    return rows.select(
        F.lit(run_id).alias("run_id"), "source_file", F.lit(stamp).cast("timestamp").alias("loaded_at"),
        "raw_line", F.array(F.lit("row longer than header")).alias("reasons"),
    )


def _rows_per_file(store: Store, spec: SourceSpec, parts: Sequence[str]) -> DataFrame | None:
    if not parts:
        return None
    rows = store.read_parts("staging", spec.table, parts)
    return rows.groupBy(F.col("source_file").alias("file_path")).agg(F.count("*").alias("rows"))


def _events(spark, found, outcome, loaded, spec, run_id, stamp) -> DataFrame:
    rows = [
        (run_id, "csv", spec.name, f.file_path, f.file_name, f.file_keys, f.file_hash_sha256, f.file_size_bytes,
         f.modified_at, stamp, *outcome[f.file_path])
        for f in found
    ]
    schema = (
        "run_id string, source_type string, source string, file_path string, file_name string, file_keys string, "
        "file_hash_sha256 string, file_size_bytes bigint, modified_at timestamp, detected_at timestamp, state string, "
        "message string, part string"
    )
    files = spark.createDataFrame(rows, schema)
    counts = loaded if loaded is not None else spark.createDataFrame([], "file_path string, rows bigint")
    number = F.coalesce("rows", F.lit(0)).cast("bigint")
    is_loaded = F.col("state") == "LOADED"
    return (
        files.join(counts, "file_path", "left")
        .withColumn("status", F.when(is_loaded & (number == 0), "SKIPPED").otherwise(F.col("state")))
        .withColumn("rows_loaded", F.when(F.col("state") != "FAILED", number))
        .withColumn("error_message", F.when(is_loaded & (number == 0), "No rows after transform").otherwise(F.col("message")))
        .drop("rows", "state", "message")
    )


def _totals(events: DataFrame):
    return events.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows"),
        F.count_if(F.col("status") == "FAILED").alias("bad"),
    ).first()


def ingest_all(
    spark: SparkSession, specs: Sequence[SourceSpec], root: str, store: Store, triggered_by: str = "manual", **options
) -> str:
    """One run over several sources; returns its id."""
    run_id = store.start_run("csv_lane", triggered_by)
    failed = []
    for spec in specs:
        try:
            with store.step(run_id, f"ingest.{spec.name}") as facts:
                totals = _totals(ingest(spark, spec, root, store, run_id, **options))
                facts.update(rows_in=totals.files, rows_out=totals.rows)
                if totals.bad:
                    failed.append(f"{spec.name}: {totals.bad} files failed")
        except Exception as error:  # noqa: BLE001
            failed.append(f"{spec.name}: {error}")
    store.finish_run(run_id, "FAILED" if failed else "SUCCESS", "; ".join(failed) or None)
    return run_id
