"""Document and enrichment queries on the given text tables, whole texts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import documents as docs
from recordmill.operators import enrich as en
from recordmill.operators.ranking import with_position
from recordmill.session import shared_dir
from recordmill.sources.store import Store
from workload.tables import table

QUERIES, ORACLE = {}, {}

# --- documents --------------------------------------------------------------

_SPACE = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
_BREAK = "\\r\\n|[\\n\\x{0B}\\f\\r\\x{85}\\x{2028}\\x{2029}]"
# The months of the input's dates.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its whole text as one page."""
    return table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" _x.pdf")).alias("source_file"),
        F.array("text").alias("pages"),
        F.lit(None).cast("string").alias("error"),
    )


def _lines_sql() -> str:
    """(document_id, line_number, line) of the whole texts."""
    return f"""select document_id, row_number() over (partition by document_id order by n) as line_number, line
    from (select document_id, n, regexp_replace(part, '^{_SPACE}|{_SPACE}$', '', 'g') as line
          from (select cast(doc_id as varchar) as document_id, unnest(parts) as part,
                       generate_subscripts(parts, 1) as n
                from (select doc_id, regexp_split_to_array(text, '{_BREAK}') as parts from documents)))
    where line <> ''"""


QUERIES["document_lines"] = lambda spark, d: docs.line_rows(_raw(spark, d))
ORACLE["document_lines"] = f"select document_id, line_number, line from ({_lines_sql()})"

QUERIES["document_pages"] = lambda spark, d: docs.page_rows(
    _raw(spark, d).withColumn("pages", F.split(F.col("pages")[0], "\n"))
)
ORACLE["document_pages"] = """
    select cast(doc_id as varchar) as document_id, 'doc ' || doc_id || ' _x.pdf' as source_file,
           generate_subscripts(parts, 1) as page_number, unnest(parts) as text
    from (select doc_id, string_split(text, chr(10)) as parts from documents)"""

QUERIES["document_register"] = lambda spark, d: docs.registered(
    table(spark, d, "documents").select("doc_id", "lang", "source", "text"), F.col("text"), ["doc_id"]
).select("document_id", "doc_id", "lang", "source")
ORACLE["document_register"] = """
    select sha256(text) as document_id, doc_id, lang, source from documents
    qualify row_number() over (partition by sha256(text) order by doc_id) = 1"""

QUERIES["section_of_turns"] = lambda spark, d: docs.section_rows(
    table(spark, d, "conversations"), "conv_id", "turn", F.col("role") == "assistant",
    (F.col("role") == "user") & (F.length("text") > 150),
)
ORACLE["section_of_turns"] = """
    with s as (select conv_id, min(turn) as b from conversations where role = 'assistant' group by 1),
    e as (select c.conv_id, min(turn) as f from conversations c join s on s.conv_id = c.conv_id
          where turn > b and role = 'user' and length(text) > 150 group by 1)
    select c.* from conversations c join s on s.conv_id = c.conv_id left join e on e.conv_id = c.conv_id
    where turn > b and (f is null or turn < f)"""


def _profile_line(line: Column, i: Column) -> Column:
    """A profile made of the document's own lines: some become markers, dates or noise."""
    n = F.length(line)
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), (n % 12 + 1).cast("int"))
    end = F.when(n % 3 == 0, "Present").otherwise("Dec 2024")
    date = F.concat(month, F.lit(" "), (n % 24 + 2000).cast("string"), F.lit(" - "), end, F.lit(" · "), line)
    return (
        F.when(i == 1, F.lit(docs.START_MARKER))
        .when(i % 40 == 39, F.lit("Education"))
        .when(n % 7 == 0, F.lit("Show all"))
        .when(i % 4 == 0, date)
        .when(n % 5 == 0, F.concat(line, F.lit(" · Full-time · x")))
        .when(n % 5 == 1, F.concat(F.lit("PhD "), line))
        .otherwise(line)
    )


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    # A bar separates the fields of a rendered role.
    plain = F.transform(docs.document_lines(F.col("pages")), lambda x: F.replace(x, F.lit("|"), F.lit("/")))
    lines = F.transform(plain, _profile_line)
    # Two pages: the second half of the lines starts a new one.
    half = (F.size("__lines") / 2).cast("int")
    pages = F.array(
        F.array_join(F.slice("__lines", F.lit(1), half), "\n"),
        F.array_join(F.slice("__lines", half + 1, F.size("__lines")), "\n"),
    )
    made = raw.withColumn("__lines", lines).withColumn("pages", pages)
    failed = F.when(F.size("__lines") < 2, F.lit("unreadable"))
    return made.withColumn("error", failed).drop("__lines")


def _profile_ctes() -> str:
    months = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
    date = (
        f"{months}[length(line) % 12 + 1] || ' ' || (length(line) % 24 + 2000) || ' - ' || "
        "case when length(line) % 3 = 0 then 'Present' else 'Dec 2024' end || ' · ' || line"
    )
    is_date = "regexp_matches(line, '^(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\\s+\\d{4}\\s*-\\s*(Present|(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\\s+\\d{4})\\s*·\\s*.+$')"
    return f"""with recursive raw_lines as materialized ({_lines_sql()}),
    doc_lines as materialized (
      select document_id, i, case when i = 1 then 'Experience' when i % 40 = 39 then 'Education'
             when length(line) % 7 = 0 then 'Show all' when i % 4 = 0 then {date}
             when length(line) % 5 = 0 then line || ' · Full-time · x'
             when length(line) % 5 = 1 then 'PhD ' || line else line end as line
      from (select document_id, line_number - 1 as i, replace(line, '|', '/') as line from raw_lines)),
    bounds as (select document_id, min(i) filter (line = 'Experience') as b, count(*) as lines from doc_lines group by 1),
    stops as (select l.document_id, min(i) as f from doc_lines l join bounds on bounds.document_id = l.document_id
              where i > b and line in ('Education', 'Licenses & certifications', 'Skills') group by 1),
    l as materialized (
      select *, min(case when is_date then n end) over w as nd, min(case when not noise then n end) over w as nn
      from (select l.document_id, line, {is_date} as is_date, line in ('Show all posts', 'Show all') as noise,
                   row_number() over (partition by l.document_id order by i) as n
            from doc_lines l join bounds on bounds.document_id = l.document_id
            left join stops on stops.document_id = l.document_id
            where bounds.lines >= 2 and i > b and (f is null or i < f))
      window w as (partition by document_id order by n rows between current row and unbounded following)),
    chain as (
      select document_id, nn as s, 1 as idx from l where n = 1 and nn is not null
      union all
      select c.document_id, l2.nn, c.idx + 1 from chain c
      join l l1 on l1.document_id = c.document_id and l1.n = c.s + 2 and l1.nd is not null
      join l l2 on l2.document_id = c.document_id and l2.n = l1.nd + 2 where l2.nn is not null),
    roles as materialized (
      select c.document_id, 'doc ' || c.document_id || ' _x.pdf' as source_file, cast(c.idx as integer) as role_index,
             t.line as title,
             case when contains(co.line, '·') then trim(split_part(co.line, '·', 1)) else co.line end as company,
             case when contains(co.line, '·') then trim(substring(co.line, instr(co.line, '·') + 1)) end as employment_type,
             dt.line as dates, lo.line as location
      from chain c join l t on t.document_id = c.document_id and t.n = c.s
      join l co on co.document_id = c.document_id and co.n = c.s + 1
      join l l1 on l1.document_id = c.document_id and l1.n = c.s + 2 and l1.nd is not null
      join l dt on dt.document_id = c.document_id and dt.n = l1.nd
      left join l lo on lo.document_id = c.document_id and lo.n = l1.nd + 1)"""


QUERIES["document_records"] = lambda spark, d: docs.role_rows(docs.parsed(_profiles(spark, d)))
ORACLE["document_records"] = _profile_ctes() + " select * from roles"

QUERIES["document_status"] = lambda spark, d: docs.document_status(docs.parsed(_profiles(spark, d)))
_STATUS = """select d.document_id,
       case when coalesce(b.lines, 0) < 2 then 'FAILED' when r.n is null then 'NEEDS_REVIEW' else 'PARSED' end as status,
       case when coalesce(b.lines, 0) < 2 then 'unreadable' when r.n is null
            then 'No roles parsed from Experience section' end as error_message
    from (select cast(doc_id as varchar) as document_id from documents) d
    left join bounds b on b.document_id = d.document_id
    left join (select document_id, count(*) as n from roles group by 1) r on r.document_id = d.document_id"""
ORACLE["document_status"] = f"{_profile_ctes()} {_STATUS}"

# --- enrichment -------------------------------------------------------------

TASK = en.Task("rules", "status_v1", "Decide from the roles.\nRoles:\n{{ROLES}}\nEnd.", max_attempts=1)


def _calls(spark: SparkSession, d: str) -> DataFrame:
    """One earlier call per labelled document."""
    labels = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return labels.select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.lit("rules").alias("model"),
        F.lit("status_v1").alias("prompt_version"),
        F.sha2("text", 256).alias("input_hash_sha256"),
        F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILED").alias("status"),
        (F.col("toxic") == 0).alias("validated"),
    )


_CALLS_SQL = """calls as (select cast(l.doc_id as varchar) as document_id, sha256(text) as input_hash_sha256,
    case when quality = 1 then 'SUCCESS' else 'FAILED' end as status, toxic = 0 as validated
    from labels l join documents d on d.doc_id = l.doc_id)"""


def _work(spark: SparkSession, d: str) -> DataFrame:
    waiting = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.when(F.col("n_chars") % 3 == 0, "FAILED").when(F.col("lang") == "en", "PARSED").otherwise("ENRICHED").alias("status"),
        F.col("n_chars").alias("ingested_at"),
    )
    return en.work_list(waiting, _calls(spark, d), TASK)


QUERIES["enrich_work_order"] = lambda spark, d: with_position(_work(spark, d)).select("position", "document_id")
QUERIES["enrich_work_list"] = _work
ORACLE["enrich_work_list"] = f"""with {_CALLS_SQL},
    tried as (select document_id, count(*) as n from calls
              where status = 'FAILED' or (status = 'SUCCESS' and not validated) group by 1),
    w as (select cast(doc_id as varchar) as document_id, n_chars as ingested_at,
                 case when n_chars % 3 = 0 then 'FAILED' when lang = 'en' then 'PARSED' else 'ENRICHED' end as status
          from documents)
    select w.document_id, w.status, w.ingested_at, coalesce(n, 0) as attempts
    from w left join tried on tried.document_id = w.document_id
    where status in ('PARSED', 'NEEDS_REVIEW') or (status = 'FAILED' and coalesce(n, 0) < 1)"""
ORACLE["enrich_work_order"] = f"""select row_number() over (order by ingested_at desc nulls last, document_id) as position, document_id
    from ({ORACLE["enrich_work_list"]})"""


def _turn_prompts(spark: SparkSession, d: str) -> DataFrame:
    roles = table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("document_id"),
        F.col("turn").alias("role_index"),
        F.col("role").alias("title"),
        F.col("text").alias("company"),
        F.lit(None).cast("string").alias("dates"),
        F.when(F.col("role") == "user", F.lit("Torino")).alias("location"),
    )
    return en.prompts(roles, TASK)


QUERIES["enrich_prompts"] = _turn_prompts
ORACLE["enrich_prompts"] = """
    select document_id, prompt, sha256(prompt) as input_hash_sha256
    from (select cast(conv_id as varchar) as document_id,
                 'Decide from the roles.' || chr(10) || 'Roles:' || chr(10)
                 || string_agg('- ' || role || ' | ' || text || ' | None | '
                               || case when role = 'user' then 'Torino' else 'None' end, chr(10) order by turn)
                 || chr(10) || 'End.' as prompt
          from conversations group by 1)"""


def _pending(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"), F.sha2("text", 256).alias("input_hash_sha256")
    )
    return en.not_validated_yet(asked, _calls(spark, d), TASK)


QUERIES["enrich_skip_done"] = _pending
ORACLE["enrich_skip_done"] = f"""with {_CALLS_SQL}
    select cast(doc_id as varchar) as document_id, sha256(text) as input_hash_sha256 from documents d
    where not exists (select 1 from calls c where c.document_id = cast(d.doc_id as varchar)
                      and c.input_hash_sha256 = sha256(d.text) and c.status = 'SUCCESS' and c.validated)"""


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of every shape, made from the events."""
    e = table(spark, d, "events")
    who = F.col("user_id").cast("string")
    whole = F.concat(
        F.lit('{"is_current_phd": '), F.when(F.col("value") > 20, "true").otherwise("null"),
        F.lit(', "current_employer": "E'), who, F.lit('", "evidence": "e'), who, F.lit('", "props": '), "props", F.lit("}"),
    )
    text = (
        F.when(F.col("event_type") == "click", whole)
        .when(F.col("event_type") == "error", F.concat(F.lit("Sure:\n```json\n"), whole, F.lit("\n```\nDone {}.")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("Here: "), whole, F.lit(" as asked.")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"is_current_phd": "yes", "current_title": 5, "evidence": null, "p": '), "props", F.lit("}")))
        .when(F.col("value") > 20, F.concat(F.lit("["), "props", F.lit("]")))
        .when(F.col("value") > 5, F.lit("no idea"))
    )
    return e.select("event_id", text.alias("response_text"))


def _validated(spark: SparkSession, d: str) -> DataFrame:
    return en.validated(_answers(spark, d))


QUERIES["enrich_validate"] = _validated
ORACLE["enrich_validate"] = """
    with a as (select event_id, event_type, value, user_id, props,
                 '{"is_current_phd": ' || case when value > 20 then 'true' else 'null' end || ', "current_employer": "E'
                 || user_id || '", "evidence": "e' || user_id || '", "props": ' || props || '}' as whole from events),
    t as (select *, case when event_type = 'click' then whole
                 when event_type = 'error' then 'Sure:' || chr(10) || '```json' || chr(10) || whole || chr(10) || '```' || chr(10) || 'Done {}.'
                 when event_type = 'signup' then 'Here: ' || whole || ' as asked.'
                 when event_type = 'view' then '{"is_current_phd": "yes", "current_title": 5, "evidence": null, "p": ' || props || '}'
                 when value > 20 then '[' || props || ']' when value > 5 then 'no idea' end as response_text from a),
    c as (select *, case when regexp_matches(response_text, '(?s)```(?:json)?\\s*(\\{.*?\\})\\s*```')
                         then regexp_extract(response_text, '(?s)```(?:json)?\\s*(\\{.*?\\})\\s*```', 1)
                         when regexp_matches(response_text, '(?s)\\{.*\\}') then regexp_extract(response_text, '(?s)\\{.*\\}')
                         else trim(response_text) end as cand from t),
    j as (select *, case when json_valid(cand) then cand::json end as doc from c),
    k as (select *, case when response_text is null then 'no answer' when doc is null then 'not valid JSON'
                 when json_type(doc) <> 'OBJECT' then 'not an object'
                 else nullif(concat_ws('; ',
                   case when coalesce(json_type(doc, '$.evidence'), '') <> 'VARCHAR' then 'evidence: text required' end,
                   case when coalesce(json_type(doc, '$.current_employer'), 'NULL') not in ('VARCHAR', 'NULL') then 'current_employer: not a text' end,
                   case when coalesce(json_type(doc, '$.current_title'), 'NULL') not in ('VARCHAR', 'NULL') then 'current_title: not a text' end,
                   case when coalesce(json_type(doc, '$.since_month'), 'NULL') not in ('VARCHAR', 'NULL') then 'since_month: not a text' end,
                   case when coalesce(json_type(doc, '$.is_current_phd'), 'NULL') = 'NULL' then 'is_current_phd must be true/false (not null)'
                        when json_type(doc, '$.is_current_phd') <> 'BOOLEAN' then 'is_current_phd: not a boolean' end), '') end as validation_errors from j)
    select event_id, response_text, case when doc is not null then cand end as response_json,
           validation_errors, validation_errors is null as validated,
           case when validation_errors is null then cast(doc->>'$.is_current_phd' as boolean) end as is_current_phd,
           case when validation_errors is null then doc->>'$.current_employer' end as current_employer,
           case when validation_errors is null then doc->>'$.current_title' end as current_title,
           case when validation_errors is null then doc->>'$.since_month' end as since_month,
           case when validation_errors is null then doc->>'$.evidence' end as evidence
    from k"""


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    """A whole enrichment run on the parsed profiles, with the rule-based predict function."""
    store = Store(spark, _scratch(spark))
    parsed = docs.parsed(_profiles(spark, d))
    waiting = docs.document_status(parsed).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))
    store.replace("staging", "doc_roles", docs.role_rows(parsed))
    store.replace("etl", "documents", waiting)
    en.enrich(store, store.read("etl", "documents"), store.read("staging", "doc_roles"), TASK, en.predict_by_rules)
    status = store.read("core", "entity_status")
    after = store.read("etl", "documents").select("document_id", "status")
    return after.join(status, "document_id", "left").select(
        "document_id", "status", "is_current_phd", "current_employer", "current_title", "since_month", "evidence"
    )


QUERIES["enrich_run"] = _enriched
_CURRENT = """now as (select * from roles where regexp_matches(dates, '-\\s*Present\\b')
    qualify row_number() over (partition by document_id order by role_index) = 1)"""
ORACLE["enrich_run"] = f"""{_profile_ctes()}, before as ({_STATUS}), {_CURRENT}
    select b.document_id,
           case when b.status <> 'PARSED' then b.status when n.document_id is null then 'FAILED' else 'ENRICHED' end as status,
           regexp_matches(n.title, '(?i)phd|ph\\.d|dottorando|doctoral') as is_current_phd, n.company as current_employer,
           n.title as current_title,
           strftime(strptime('1 ' || regexp_extract(n.dates, '^(\\w{{3}}\\s+\\d{{4}})', 1), '%d %b %Y'), '%Y-%m') as since_month,
           n.title || ' | ' || n.company || ' | ' || n.dates as evidence
    from before b left join now n on n.document_id = b.document_id"""

QUERIES["enrich_rules"] = lambda spark, d: en.status_by_rules(docs.role_rows(docs.parsed(_profiles(spark, d))))
ORACLE["enrich_rules"] = f"""{_profile_ctes()}, {_CURRENT}
    select document_id, regexp_matches(title, '(?i)phd|ph\\.d|dottorando|doctoral') as is_current_phd,
           company as current_employer, title as current_title,
           strftime(strptime('1 ' || regexp_extract(dates, '^(\\w{{3}}\\s+\\d{{4}})', 1), '%d %b %Y'), '%Y-%m') as since_month,
           title || ' | ' || company || ' | ' || dates as evidence from now"""


LIMITED = en.Task(
    "service", "status_v2", TASK.template, max_attempts=1,
    limits=en.Limits(timeout=0.5, tries=2, backoff=0.01, batch=4, workers=4),
)


def _uneven_service():
    """A service that hangs on some prompts, refuses others, gives some answers that are not valid, and takes several
    prompts at once. It goes by the prompt's hash, so an answer does not depend on the call it was part of."""
    import hashlib
    import json
    import time

    def predict(texts):
        out = []
        for text in texts:
            h = hashlib.sha256(text.encode()).hexdigest()
            if h.startswith("00"):
                time.sleep(20)
            if h.startswith("1"):
                raise ValueError("refused")
            out.append("no idea" if h.startswith("2") else json.dumps({"is_current_phd": h[2] < "8", "evidence": h}))
        return out

    return predict


def _call_log(spark: SparkSession, d: str) -> DataFrame:
    """The stored log of a run in which calls hang, fail and give answers of no use."""
    store = Store(spark, _scratch(spark))
    turns = table(spark, d, "conversations").withColumn("document_id", F.col("conv_id").cast("string"))
    roles = turns.select(
        "document_id", F.col("turn").alias("role_index"), F.col("role").alias("title"), F.col("text").alias("company"),
        F.lit(None).cast("string").alias("dates"), F.lit(None).cast("string").alias("location"),
    )
    waiting = turns.select("document_id").distinct().select(
        "document_id", F.lit("PARSED").alias("status"), F.lit(None).cast("string").alias("error_message"),
        F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
    )
    store.replace("etl", "documents", waiting)
    run_id = en.enrich(store, store.read("etl", "documents"), roles, LIMITED, _uneven_service())
    after = store.read("etl", "documents").select("document_id", F.col("status").alias("document_status"))
    calls = store.read_log("llm_calls").where(F.col("run_id") == run_id)
    in_time = (F.col("ended_at") >= F.col("started_at")) & F.col("latency_ms").between(0, 10_000)
    return calls.join(after, "document_id").select(
        "document_id", "model", "prompt_version", "input_hash_sha256", "parameters", "status", "error_message",
        "response_text", "response_json", "validated", "validation_errors", in_time.alias("in_time"), "document_status",
    )


QUERIES["enrich_call_log"] = _call_log
ORACLE["enrich_call_log"] = """
    with asked as (
        select cast(conv_id as varchar) as document_id,
               sha256('Decide from the roles.' || chr(10) || 'Roles:' || chr(10)
                      || string_agg('- ' || role || ' | ' || text || ' | None | None', chr(10) order by turn)
                      || chr(10) || 'End.') as input_hash_sha256
        from conversations group by 1),
    answered as (
        select *, case when input_hash_sha256 like '00%' or input_hash_sha256 like '1%' then null
                       when input_hash_sha256 like '2%' then 'no idea'
                       else '{"is_current_phd": ' || case when substr(input_hash_sha256, 3, 1) < '8' then 'true' else 'false' end
                            || ', "evidence": "' || input_hash_sha256 || '"}' end as response_text
        from asked),
    checked as (
        select *, case when response_text is null then 'no answer' when response_text = 'no idea' then 'not valid JSON' end as validation_errors
        from answered)
    select document_id, 'service' as model, 'status_v2' as prompt_version, input_hash_sha256, '{"temperature": 0.0}' as parameters,
           case when validation_errors is null then 'SUCCESS' else 'FAILED' end as status,
           case when input_hash_sha256 like '00%' then 'no answer within 0.5 s' when input_hash_sha256 like '1%' then 'refused'
                when validation_errors is not null then 'Validation failed: ' || validation_errors end as error_message,
           response_text, case when validation_errors is null then response_text end as response_json,
           validation_errors is null as validated, validation_errors, true as in_time,
           case when validation_errors is null then 'ENRICHED' else 'FAILED' end as document_status
    from checked"""
