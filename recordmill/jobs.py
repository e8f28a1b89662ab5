"""The jobs a user runs: load files, build the layers, check them, parse documents, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import documents as docs
from recordmill.operators.enrich import Predict, Task, enrich
from recordmill.operators.quality import enforce, run_checks
from recordmill.plans import checks, core, marts
from recordmill.sources.ingest import ingest_all
from recordmill.sources.pages import Extract, discover, first_copies, page_texts
from recordmill.sources.specs import SPECS, SourceSpec
from recordmill.sources.store import Store, now

ROLES = (
    "document_id string, source_file string, role_index int, title string, company string, "
    "employment_type string, dates string, location string"
)
DOCUMENTS = (
    "document_id string, run_id string, source_path string, source_file string, doc_type string, "
    "ingested_at timestamp, status string, error_message string"
)
STATUS = (
    "document_id string, run_id string, model string, prompt_version string, is_current_phd boolean, "
    "current_employer string, current_title string, since_month string, evidence string, "
    "source_call_hash string, updated_at timestamp"
)


def load_files(spark: SparkSession, root: str, store: Store, specs: Sequence[SourceSpec] | None = None, **options) -> str:
    """Load all new files of all sources into staging."""
    return ingest_all(spark, specs or list(SPECS.values()), root, store, **options)


def staging_table(store: Store, table: str) -> DataFrame:
    spec = next(s for s in SPECS.values() if s.table == table)
    kinds = {"loaded_at": "timestamp"}
    return store.read("staging", table, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in spec.staged_columns))


def build_core_layer(
    store: Store,
    newest_load: dict[str, Sequence[str]] | None = None,
    latest_enrolments: bool = False,
    per_teacher: bool = False,
) -> dict[str, DataFrame]:
    """Rebuild every core table as a new version.

    ``newest_load`` names staging tables whose files are re-sent whole, with their keys: only the newest load of a key
    counts. ``latest_enrolments`` keeps one enrolment per student, course and year, ``per_teacher`` one course detail
    per teacher; without them rows stay as delivered.
    """
    options = {"students_courses": {"latest_only": latest_enrolments}, "course_details": {"per_teacher": per_teacher}}
    for name, (build, source) in core.SOURCES.items():
        rows = staging_table(store, source)
        if newest_load and source in newest_load:
            rows = core.latest_load_only(rows, newest_load[source])
        store.replace("core", name, build(rows, **options.get(name, {})))
    mobility = "mobilita_internazionale_con_studenti"
    people = store.read("core", "students")
    store.replace("core", mobility, core.mobilita_internazionale_con_studenti(staging_table(store, mobility), people))
    return core_layer(store)


class RejectedValues(RuntimeError):
    pass


def quarantine_rejects(store: Store, strict: bool = False) -> dict[str, int]:
    """Store the staged rows with a text that cannot be typed, per core table; with ``strict`` raise if there are any."""
    found = {}
    mobility = ("mobilita_internazionale_con_studenti", "mobilita_internazionale_con_studenti")
    for name, source in [*((n, s) for n, (_, s) in core.SOURCES.items()), mobility]:
        store.replace("quarantine", f"rejected_{name}", core.rejected_values(staging_table(store, source), name))
        if n := store.read("quarantine", f"rejected_{name}").count():
            found[name] = n
    if strict and found:
        raise RejectedValues("; ".join(f"{name}: {n} rows" for name, n in found.items()))
    return found


def core_layer(store: Store) -> dict[str, DataFrame]:
    names = [*core.SOURCES, "mobilita_internazionale_con_studenti"]
    return {n: store.read("core", n) for n in names}


def build_mart_layer(store: Store) -> dict[str, DataFrame]:
    """Rebuild every mart from the stored core tables."""
    status = store.read("core", "entity_status", STATUS)
    roles = store.read("staging", "doc_roles", ROLES)
    for name, mart in marts.build_marts(core_layer(store), status, roles).items():
        store.replace("marts", name, mart)
    return {n: store.read("marts", n) for n in marts.MART_NAMES}


def check_core_layer(store: Store, run_id: str, this_year: int) -> DataFrame:
    """Run the core checks, store the results, then fail on errors."""
    stamp = now()
    results = run_checks(core_layer(store), checks.core_checks(this_year), run_id, f"{stamp:%Y-%m-%d %H:%M:%S}")
    store.append_log("validation_results", results)
    stored = store.read_log("validation_results").where(F.col("run_id") == run_id)
    enforce(stored)
    return stored


def check_control_tables(store: Store, run_id: str) -> DataFrame:
    """Check the status values of the control tables and store the results."""
    logs = ("file_manifest", "step_metrics", "validation_results", "llm_calls")
    tables = {name: store.read_log(name) for name in logs}
    tables |= {"runs": store.runs(), "documents": store.read("etl", "documents", DOCUMENTS)}
    results = run_checks(tables, checks.CONTROL_CHECKS, run_id, f"{now():%Y-%m-%d %H:%M:%S}")
    store.append_log("validation_results", results)
    stored = store.read_log("validation_results").where(F.col("run_id") == run_id)
    enforce(stored)
    return stored


def parse_documents(spark: SparkSession, root: str, store: Store, extract: Extract, pattern: str = "*.pdf") -> str:
    """Register document files, store their pages and role records, and set their status."""
    run_id = store.start_run("document_lane")
    try:
        with store.step(run_id, "documents.parse") as facts:
            pages = first_copies(page_texts(discover(spark, root, pattern), extract))
            store.replace("staging", "documents_in_work", docs.parsed(pages))
            work = store.read("staging", "documents_in_work")
            facts["rows_in"] = work.count()
            ids = work.select("document_id")
            for table, rows in (("doc_pages", docs.page_rows(work)), ("doc_roles", docs.role_rows(work))):
                old = store.read("staging", table)
                store.replace("staging", table, rows if old is None else docs.replace_roles(old, rows, ids))
            known = store.read("etl", "documents", DOCUMENTS).select("document_id", F.col("ingested_at").alias("__first"))
            states = (
                work.join(docs.document_status(work), "document_id")
                .join(known, "document_id", "left")
                .select(
                    "document_id", F.lit(run_id).alias("run_id"), "source_path", "source_file",
                    F.lit("pdf").alias("doc_type"),
                    F.coalesce("__first", F.lit(now()).cast("timestamp")).alias("ingested_at"), "status", "error_message",
                )
            )
            store.upsert("etl", "documents", states, ["document_id"])
            facts["rows_out"] = facts["rows_in"]
        store.finish_run(run_id, "SUCCESS")
    except Exception as error:
        store.finish_run(run_id, "FAILED", str(error))
        raise
    return run_id


def enrich_documents(store: Store, task: Task, predict: Predict) -> str:
    """Ask the user function for the status of every document that is due."""
    return enrich(
        store, store.read("etl", "documents", DOCUMENTS), store.read("staging", "doc_roles", ROLES), task, predict
    )

