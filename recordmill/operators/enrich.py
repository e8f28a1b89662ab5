"""Batch enrichment of documents by a user function, with call log and validation."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.keys import text_hash
from recordmill.operators.deadline import Limits, ask_all
from recordmill.operators.lists import text_list
from recordmill.sources.store import Store, merged

ROLES_TOKEN = "{{ROLES}}"
# Fixed rules of the status decision.
CURRENT = r"-\s*Present\b"
PHD_TITLE = r"(?i)phd|ph\.d|dottorando|doctoral"
TEXT_FIELDS = ("current_employer", "current_title", "since_month")

CALL = (
    "document_id string, input_hash_sha256 string, response_text string, error_message string, "
    "started_at timestamp, ended_at timestamp, latency_ms bigint"
)
# Prompts that a Python worker is handed at a time, at most, and their bytes.
PROMPTS, PROMPT_BYTES = 1000, 4 << 20
Predict = Callable[[Sequence[str]], Sequence[str]]


@dataclass(frozen=True)
class Task:
    """What is asked: model name, prompt version and template, and the limits."""

    model: str
    prompt_version: str
    template: str
    max_attempts: int = 3
    limits: Limits = Limits()
    parameters: str = '{"temperature": 0.0}'


def attempts(calls: DataFrame, task: Task) -> DataFrame:
    """Calls per document that failed or whose answer was not valid."""
    bad = (F.col("status") == "FAILED") | ((F.col("status") == "SUCCESS") & ~F.col("validated"))
    own = calls.where((F.col("model") == task.model) & (F.col("prompt_version") == task.prompt_version))
    return own.where(bad).groupBy("document_id").agg(F.count("*").alias("attempts"))


def due_documents(documents: DataFrame, calls: DataFrame, task: Task) -> DataFrame:
    """Parsed documents, and failed ones with attempts left, in no order."""
    counted = documents.join(attempts(calls, task), "document_id", "left").withColumn(
        "attempts", F.coalesce("attempts", F.lit(0))
    )
    due = F.col("status").isin("PARSED", "NEEDS_REVIEW") | (
        (F.col("status") == "FAILED") & (F.col("attempts") < task.max_attempts)
    )
    return counted.where(due)


def work_list(documents: DataFrame, calls: DataFrame, task: Task) -> DataFrame:
    """The due documents, newest first."""
    return due_documents(documents, calls, task).orderBy(F.col("ingested_at").desc_nulls_last(), "document_id")


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("None"))


def prompts(roles: DataFrame, task: Task) -> DataFrame:
    """(document_id, prompt, input_hash_sha256); documents without roles have none."""
    line = F.concat(
        F.lit("- "), _shown("title"), F.lit(" | "), _shown("company"), F.lit(" | "), _shown("dates"),
        F.lit(" | "), _shown("location"),
    )
    blocks = text_list(roles, ["document_id"], line, [F.col("role_index")], "\n", "roles_block")
    prompt = F.replace(F.lit(task.template), F.lit(ROLES_TOKEN), F.col("roles_block"))
    return blocks.select("document_id", prompt.alias("prompt")).withColumn(
        "input_hash_sha256", text_hash("prompt")
    )


def not_validated_yet(asked: DataFrame, calls: DataFrame, task: Task) -> DataFrame:
    """Prompts without a successful, validated call for exactly this text."""
    done = calls.where(
        (F.col("model") == task.model)
        & (F.col("prompt_version") == task.prompt_version)
        & (F.col("status") == "SUCCESS")
        & F.col("validated")
    )
    keys = ["document_id", "input_hash_sha256"]
    return asked.join(done.select(*keys), keys, "left_anti")


def call(asked: DataFrame, predict: Predict, limits: Limits | None = None, tasks: int | None = None) -> DataFrame:
    """Answers of ``predict``, called inside the tasks with a deadline, tries and workers as ``limits`` says.

    Calls are slow and rows small, so the prompts are spread by number, not by size. Every prompt has one row: its
    answer, or the error of its last try; prompts that were asked together and failed are asked one by one, so an
    error stays with its document and a call that hangs costs its deadline, not the run. A worker holds some
    ``PROMPT_BYTES`` of prompts at a time, however many its task has and however long they are.
    """
    limits = limits or Limits()

    def stamp(seconds: float) -> datetime:
        return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = list(ask_all(predict, list(batch["prompt"]), limits))
            yield pd.DataFrame(
                {
                    "document_id": batch["document_id"],
                    "input_hash_sha256": batch["input_hash_sha256"],
                    "response_text": [a.text for a in got],
                    "error_message": [a.error for a in got],
                    "started_at": [stamp(a.started) for a in got],
                    "ended_at": [stamp(a.ended) for a in got],
                    "latency_ms": [int(a.seconds * 1000) for a in got],
                }
            )

    asked.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", PROMPTS)
    asked.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", PROMPT_BYTES)
    tasks = tasks or asked.sparkSession.sparkContext.defaultParallelism
    spread = asked.select("document_id", "input_hash_sha256", "prompt").repartition(tasks, "document_id", "input_hash_sha256")
    return spread.mapInPandas(ask, CALL)


def json_candidate(text: Column) -> Column:
    """First fenced object, else the first brace to the last, else the whole text."""
    fenced = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
    braces = r"(?s)(\{.*\})"
    return (
        F.when(text.rlike(fenced), F.regexp_extract(text, fenced, 1))
        .when(text.rlike(braces), F.regexp_extract(text, braces, 1))
        .otherwise(F.regexp_replace(text, r"^\s+|\s+\z", ""))
    )


def validated(answers: DataFrame) -> DataFrame:
    """Check and type the answers.

    Adds ``response_json``, ``validation_errors``, ``validated`` and the typed fields,
    which are null unless the answer is valid. Types are strict: "yes" is no boolean.
    """
    parsed = answers.withColumn("__text", json_candidate(F.col("response_text"))).withColumn(
        "__json", F.try_parse_json("__text")
    )

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.expr(f"variant_get(__json, '$.{field}')"))

    is_object = F.startswith(F.schema_of_variant("__json"), F.lit("OBJECT"))
    flag = kind("is_current_phd")
    problems = [
        F.when(F.coalesce(kind("evidence"), F.lit("")) != "STRING", F.lit("evidence: text required")),
        *[
            F.when(~F.coalesce(kind(f), F.lit("VOID")).isin("STRING", "VOID"), F.lit(f"{f}: not a text"))
            for f in TEXT_FIELDS
        ],
        F.when(flag.isNull() | (flag == "VOID"), F.lit("is_current_phd must be true/false (not null)")).when(
            flag != "BOOLEAN", F.lit("is_current_phd: not a boolean")
        ),
    ]
    errors = (
        F.when(F.col("response_text").isNull(), F.lit("no answer"))
        .when(F.col("__json").isNull(), F.lit("not valid JSON"))
        .when(~is_object, F.lit("not an object"))
        .otherwise(F.nullif(F.concat_ws("; ", *problems), F.lit("")))
    )
    checked = parsed.withColumn("validation_errors", errors)
    ok = F.col("validation_errors").isNull()

    def typed(field: str, kind: str) -> Column:
        return F.when(ok, F.try_variant_get("__json", f"$.{field}", kind)).alias(field)

    return checked.select(
        *answers.columns,
        F.when(F.col("__json").isNotNull(), F.col("__text")).alias("response_json"),
        "validation_errors",
        ok.alias("validated"),
        typed("is_current_phd", "boolean"),
        *[typed(f, "string") for f in TEXT_FIELDS],
        typed("evidence", "string"),
    )


def call_rows(answers: DataFrame, task: Task, run_id: str) -> DataFrame:
    """Validated answers as rows of the call log; an invalid answer is a failed call."""
    return answers.select(
        F.lit(run_id).alias("run_id"), "document_id", F.lit(task.model).alias("model"),
        F.lit(task.prompt_version).alias("prompt_version"), "input_hash_sha256",
        F.lit(task.parameters).alias("parameters"),
        F.when(F.col("validated"), "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(~F.col("validated"),
               F.coalesce("error_message", F.concat(F.lit("Validation failed: "), "validation_errors"))).alias("error_message"),
        "started_at", "ended_at", "latency_ms", "response_text", "response_json", "validated", "validation_errors",
    )


def status_rows(calls: DataFrame) -> DataFrame:
    """Typed status of the validated calls, the latest per document."""
    from recordmill.operators.dedup import keep_first

    good = calls.where((F.col("status") == "SUCCESS") & F.col("validated"))
    latest = keep_first(good, ["document_id"], [F.desc("ended_at"), F.desc("input_hash_sha256")])
    return validated(latest.drop("response_json", "validation_errors", "validated")).select(
        "document_id", "run_id", "model", "prompt_version", "is_current_phd", *TEXT_FIELDS, "evidence",
        F.col("input_hash_sha256").alias("source_call_hash"), F.col("ended_at").alias("updated_at"),
    )


def status_after(documents: DataFrame, calls: DataFrame, enriched: DataFrame) -> DataFrame:
    """Documents with the status that follows from this run's calls and the status table."""
    outcome = calls.groupBy("document_id").agg(
        F.bool_or("validated").alias("__ok"), F.max_by("error_message", "ended_at").alias("__error")
    )
    known = enriched.select("document_id").distinct().withColumn("__known", F.lit(True))
    called = F.col("__ok").isNotNull()
    failed = called & ~F.col("__ok")
    return (
        documents.join(outcome, "document_id", "left")
        .join(known, "document_id", "left")
        .withColumn(
            "status",
            F.when(failed, "FAILED").when(F.col("__ok") | (F.col("__known") & ~called), "ENRICHED").otherwise(F.col("status")),
        )
        .withColumn("error_message", F.when(failed, F.col("__error")).when(F.col("status") != "ENRICHED", F.col("error_message")))
        .select(*documents.columns)
    )


def enrich(store: Store, documents: DataFrame, roles: DataFrame, task: Task, predict: Predict) -> str:
    """One run: work list, prompts, calls, log, status. Returns the run id.

    The answers are written to the log before anything is derived from them: a task that
    is run again may ask again, but every later step sees the one stored answer.
    """
    run_id = store.start_run("enrich_status")
    try:
        calls = store.read_log("llm_calls")
        due = due_documents(documents, calls, task).where(F.col("attempts") < task.max_attempts)
        asked = not_validated_yet(prompts(roles.join(due.select("document_id"), "document_id", "left_semi"), task), calls, task)
        with store.step(run_id, "enrich.calls") as facts:
            answers = validated(call(asked, predict, task.limits))
            store.append_log("llm_calls", call_rows(answers, task, run_id))
            logged = store.read_log("llm_calls").where(F.col("run_id") == run_id)
            facts["rows_out"] = logged.count()
        fresh = status_rows(logged)
        old = store.read("core", "entity_status")
        store.replace("core", "entity_status", fresh if old is None else merged(old, fresh, ["document_id"]))
        enriched = store.read("core", "entity_status")
        store.replace("etl", "documents", status_after(documents, logged, enriched))
        store.finish_run(run_id, "SUCCESS")
    except Exception as error:
        store.finish_run(run_id, "FAILED", str(error))
        raise
    return run_id


def status_by_rules(roles: DataFrame) -> DataFrame:
    """The decision rules as columns: the first current role, and whether its title is a PhD one."""
    from recordmill.operators.dedup import keep_first

    current = keep_first(roles.where(F.col("dates").rlike(CURRENT)), ["document_id"], [F.col("role_index").asc()])
    return current.select(
        "document_id",
        F.col("title").rlike(PHD_TITLE).alias("is_current_phd"),
        F.col("company").alias("current_employer"),
        F.col("title").alias("current_title"),
        since_month(F.col("dates")).alias("since_month"),
        F.concat_ws(" | ", "title", "company", "dates").alias("evidence"),
    )


def since_month(dates: Column) -> Column:
    """``Nov 2023 - …`` to ``2023-11``."""
    start = F.try_to_timestamp(F.concat(F.lit("1 "), F.regexp_extract(dates, r"^(\w{3}\s+\d{4})", 1)), F.lit("d MMM yyyy"))
    return F.date_format(start, "yyyy-MM")


# The months of the input's dates.
MONTH_NUMBERS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6, "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}


def _month_of(dates: str) -> str | None:
    found = re.match(r"(\w{3})\s+(\d{4})", dates)
    return f"{found[2]}-{MONTH_NUMBERS[found[1]]:02d}" if found and found[1] in MONTH_NUMBERS else None


def predict_by_rules(texts: Sequence[str]) -> list[str]:
    """The same rules as a ``predict`` function over rendered prompts.

    A role is a line ``- title | company | dates | location``. It is split from the right, so a title may hold a bar.
    """
    answers = []
    for text in texts:
        lines = [ln[2:].rsplit(" | ", 3) for ln in text.split("\n") if ln.startswith("- ") and ln.count(" | ") >= 3]
        now = [p for p in lines if re.search(CURRENT, p[2])]
        role = now[0] if now else None
        answers.append(
            json.dumps(
                {
                    "is_current_phd": bool(re.search(PHD_TITLE, role[0])) if role else None,
                    "current_employer": role[1] if role else None,
                    "current_title": role[0] if role else None,
                    "since_month": _month_of(role[2]) if role else None,
                    "evidence": " | ".join(role[:3]) if role else "Unknown",
                }
            )
        )
    return answers
