"""A query per loader: the derived staging of a source, whole, written as files in the source's own layout and loaded.

Rows are dealt to files by a hash, and the number of files grows with the rows. Beside the good files
stand ones that must add nothing: an empty marker, a header alone and, where columns are required, a file without one.
A file with one row longer than its header adds its other row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import shared_dir
from recordmill.sources.ingest import ingest
from recordmill.sources.specs import EMPTY_MARKER, SPECS, SourceSpec
from recordmill.sources.store import Store
from workload.oracle import sql
from workload.staging import staging

QUERIES, ORACLE = {}, {}

# Path of a file with its keys, per source with keys in the path. {0} is the first key, {1} the second.
PATHS = {
    "students": "cicli/{0}/0_students_info.csv",
    "internal_activities": "cicli/{1}/{0}_attivita_formative_interne.csv",
    "external_activities": "cicli/{1}/{0}_attivita_formative_esterne.csv",
    "offsite_activities": "cicli/{1}/{0}_attivita_formative_fuorisede.csv",
    "publications": "cicli/{1}/{0}_pubblicazioni.csv",
    "enrolments": "corsi/{0}_{1}.csv",
    "course_details": "corsi/dettaglio_corso_{0}_{1}.csv",
    "journal_details": "journal_details/journal_details_{0}.csv",
    "training_hours": "ore_formazione/ore_formazione_ciclo_{0}.csv",
    "publication_counters": "stat_pubb/stat_pubb_{0}.csv",
}
# Keys of the good files: from FIRST on, by a hash of the row, one more for every FILE_ROWS rows. The other files have
# keys of their own.
FIRST, LEAST, FILE_ROWS, OTHERS = 100, 3, 500_000, ("7", "8", "9", "10")
YEAR = {"enrolments": "2024", "course_details": "2024"}
SECOND = "35"


def _columns(spec: SourceSpec, have: list[str]) -> list[str]:
    """Columns of the file that the derived table has; the others stay empty."""
    return [c for c in spec.columns.values() if c in have]


def _path(spec: SourceSpec, key: str) -> str:
    return PATHS[spec.name].format(key, YEAR.get(spec.name, SECOND))


def _put(spark: SparkSession, path: str, text: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(text.encode()))
    out.close()


def _write(spark: SparkSession, d: str, spec: SourceSpec, root: str) -> None:
    rows = staging(spark, d, spec.table)
    have = _columns(spec, rows.columns)
    values = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(h) for h, c in spec.columns.items()]
    options = {
        "sep": spec.separator, "header": True, "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    if spec.name not in PATHS:
        # one "file" of many parts: a folder of that name is read as a file is
        rows.select(*values).write.options(**options).csv(f"{root}/{spec.glob}")
        return
    files = LEAST + rows.count() // FILE_ROWS
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in have])
    key = F.lit(FIRST) + F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int") % files
    made = f"{root}-made"
    rows.select(*values, key.alias("__key")).repartition(files, "__key").write.partitionBy("__key").options(**options).csv(made)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(made).getFileSystem(conf)
    # all rows of a key were written by one task, so each has one file
    for part in fs.globStatus(at(f"{made}/__key=*/part-*")) or []:
        target = at(f"{root}/{_path(spec, part.getPath().getParent().getName().removeprefix('__key='))}")
        fs.mkdirs(target.getParent())
        fs.rename(part.getPath(), target)
    head = spec.separator.join(spec.columns)
    short = spec.separator.join(c for c in spec.columns if c not in spec.must_have)
    good = spec.separator.join(["v"] * len(spec.columns))
    texts = [f"x\n{EMPTY_MARKER}\n", f"{head}\n", f"{head}\n{good}\n{good}{spec.separator}more\n"]
    if spec.must_have:
        texts.append(f"{short}\nv\n")
    for k, text in zip(OTHERS, texts):
        _put(spark, f"{root}/{_path(spec, k)}", text)


def _loaded(spark: SparkSession, d: str, spec: SourceSpec) -> DataFrame:
    root = f"{shared_dir(spark)}/load-{uuid.uuid4().hex}"
    _write(spark, d, spec, f"{root}/in")
    store = Store(spark, f"{root}/store")
    ingest(spark, spec, f"{root}/in", store, store.start_run("csv_lane"))
    return store.read("staging", spec.table).select(*spec.path_fields, *spec.columns.values())


def _expected(spec: SourceSpec, have: list[str]) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in spec.null_tokens)

    def value(c: str) -> str:
        text = f"case when {c} in ({tokens}) then null else {c} end" if c in have else "cast(null as varchar)"
        return f"trim({text})" if spec.explode and c == spec.explode[0] else text

    keys = list(spec.path_fields)
    text = "concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in have) + ")"
    files = f"({LEAST} + (select count(*) from stg_{spec.table}) // {FILE_ROWS})"
    first = f"cast({FIRST} + ('0x' || substr(md5({text}), 1, 6))::int % {files} as varchar)"
    at = {0: first, 1: f"'{YEAR.get(spec.name, SECOND)}'"}
    shown = [f"{at[i]} as {k}" for i, k in enumerate(keys)] + [f"{value(c)} as {c}" for c in spec.columns.values()]
    query = f"select {', '.join(shown)} from stg_{spec.table}"
    if spec.name in PATHS:
        other = {0: f"'{OTHERS[2]}'", 1: at[1]}
        row = [f"{other[i]} as {k}" for i, k in enumerate(keys)] + [f"'v' as {c}" for c in spec.columns.values()]
        query += f" union all select {', '.join(row)}"
    return sql(query, f"stg_{spec.table}")


def _have(spec: SourceSpec) -> list[str]:
    from workload.staging import STAGING

    return [c for c in spec.columns.values() if f" as {c}" in STAGING[spec.table] or f"as {c}," in STAGING[spec.table]]


for _spec in SPECS.values():
    QUERIES[f"load_{_spec.name}"] = lambda spark, d, s=_spec: _loaded(spark, d, s)
    ORACLE[f"load_{_spec.name}"] = _expected(_spec, _have(_spec))
