"""All jobs on a small tree of files, end to end."""

import json
import os
import time
from decimal import Decimal

import pytest

from recordmill import jobs
from recordmill.operators.deadline import Limits, ask_all
from recordmill.operators.enrich import Task, call, json_candidate, predict_by_rules, validated
from recordmill.operators.quality import ChecksFailed
from recordmill.plans import serving
from recordmill.sources.specs import SPECS
from recordmill.sources.store import LOGS, Store

TEMPLATE = "Decide.\nRoles:\n{{ROLES}}"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def head(name):
    spec = SPECS[name]
    return spec.separator.join(spec.columns) + "\n"


@pytest.fixture()
def root(tmp_path):
    r = str(tmp_path / "input")
    write(
        f"{r}/cicli/35/0_students_info.csv",
        head("students")
        + "1;D1;a@x.it;Rossi;Mario;35;T;;ok;12,5;10;1;2;0;3\n"
        + "2;D2;b@x.it;Verdi;Anna;35;T;;ok;1.005;2;1;2;0;3\n"
        + "3;D3;c@x.it;Verdi;  anna ;35;T;;ok;1;2;1;2;0;3\n",
    )
    write(
        f"{r}/cicli/35/1_attivita_formative_interne.csv",
        head("internal_activities")
        + 'A1,Zoology,20,"20,5",30,1,3/4/2024,Hard,L,C,"1,5"\n'
        + "A2,Algebra,-,8,30,1,03/04/2024,Soft,L,C,2\n"
        + "A3,Nothing,9,9,30,1,31/02/2024,Hard,L,C,0\n",
    )
    write(
        f"{r}/cicli/35/1_pubblicazioni.csv",
        head("publications")
        + "2024\tJ\tTitle B\tR\tRossi, M.; Esterno, Ugo\t\tsi\t50\t1\t50\t-1,5\tx\n"
        + "2024\tJ\tTitle A\tR\tEsterno, U.\t\tsi\t150\t1\t50\t1\t0\n",
    )
    write(f"{r}/corsi/A1_2024.csv", head("enrolments") + "1\tRossi\tMario\tA1\tX\t1\t-\tok\n")
    write(f"{r}/corsi/dettaglio_corso_A1_2024.csv", head("course_details") + "t\tDoc\ts\tI\t10\t1,5\t\t\t3\n")
    write(
        f"{r}/mobilita_internazionale_con_studenti.csv",
        head("mobility")
        + ",ROSSI, mario,T,35,Stage,France,Lab,P,90,2024,1/2/2024,\n"
        + ",Verdi,Anna,T,35,Stage,Spain,,P,30,2024,1/2/2024,\n",
    )
    write(f"{r}/pdf/a/Mario Rossi _x.pdf", "x\fExperience\nPhD Student\nPoli · Full\nNov 2023 - Present · 1\nTorino")
    write(f"{r}/pdf/b/copy _y.pdf", "x\fExperience\nPhD Student\nPoli · Full\nNov 2023 - Present · 1\nTorino")
    write(f"{r}/pdf/b/Anna Verdi _x.pdf", "nothing here")
    write(f"{r}/pdf/b/bad.pdf", "BAD")
    return r


def extractor():
    # Defined inside, so that it travels to the tasks by value.
    def extract(content):
        text = content.decode()
        if text == "BAD":
            raise ValueError("cannot read")
        return text.split("\f")

    return extract


def test_every_job(spark, root, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    jobs.load_files(spark, root, store)
    jobs.parse_documents(spark, f"{root}/pdf", store, extractor())
    states = {r.source_file: r.status for r in store.read("etl", "documents").collect()}
    assert states == {"Mario Rossi _x.pdf": "PARSED", "Anna Verdi _x.pdf": "NEEDS_REVIEW", "bad.pdf": "FAILED"}

    task = Task("rules", "v1", TEMPLATE)
    jobs.enrich_documents(store, task, predict_by_rules)
    first = store.read("core", "entity_status").collect()
    assert [(r.is_current_phd, r.current_employer, r.current_title) for r in first] == [(True, "Poli", "PhD Student")]
    n_calls = store.read_log("llm_calls").count()
    # Parsed again, the status is derived anew; the validated prompt is not asked again.
    jobs.parse_documents(spark, f"{root}/pdf", store, extractor())
    jobs.enrich_documents(store, task, predict_by_rules)
    assert store.read_log("llm_calls").count() == n_calls == 1
    states = {r.source_file: r.status for r in store.read("etl", "documents").collect()}
    assert states["Mario Rossi _x.pdf"] == "ENRICHED"
    assert store.read("staging", "doc_roles").count() == 1

    core = jobs.build_core_layer(store)
    people = {r.matricola_dottorando: r for r in core["students"].collect()}
    assert people["1"].ore_soft_skills == Decimal("12.50") and people["2"].ore_soft_skills == Decimal("1.01")
    inner = {r.cod_ins: (r.ore, r.data_esame and str(r.data_esame), r.anno) for r in core["attivita_interne"].collect()}
    assert inner == {
        "A1": (Decimal("20.00"), "2024-04-03", 2024), "A2": (Decimal("0.00"), "2024-04-03", 2024), "A3": (Decimal("9.00"), None, None)}
    mobility = {r.cognome: (r.matricola, r.matched_students_count) for r in core["mobilita_internazionale_con_studenti"].collect()}
    assert mobility == {"ROSSI": ("1", 1), "Verdi": (None, 2)}

    marts = jobs.build_mart_layer(store)
    hours = marts["ore_di_formazione"].collect()
    assert [(r.matricola, r.anno, r.ore_hard, r.ore_soft) for r in hours] == [("1", 2024, Decimal("20.50"), Decimal("8.00"))]
    assert hours[0].corsi_ore == "TIPO: Soft, CORSO: Algebra, ORE: 8.00\n\nTIPO: Hard, CORSO: Zoology, ORE: 20.50"
    assert [(r.publication_count, r.titles) for r in marts["pubblicazione"].collect()] == [(2, "Title A; Title B")]
    assert [(r.autore, r.n_pub) for r in marts["pubblicazione_tutori"].collect()] == [("Esterno U.", 2)]
    given = {r.matricola: (r.hour_les, r.hour_ex, r.insegnamenti) for r in marts["distribuzione_di_ore"].collect()}
    assert given["1"] == (Decimal("10.00"), Decimal("1.50"), "A1") and given["2"] == (Decimal("0.00"), Decimal("0.00"), None)
    jobs_by = {r.matricola: (r.employer, r.title) for r in marts["stato_lavorativo"].collect()}
    assert jobs_by == {"1": ("Poli", "PhD Student"), "2": ("Unknown", "Unknown"), "3": ("Unknown", "Unknown")}
    shown = serving.duration_by_country_for_years(marts["mobilita_internazionale"], [2024], 20).collect()
    assert [(r.paese, r.durata_giorni, r.dettaglio) for r in shown] == [
        ("France", 90.0, "ROSSI mario con 90 giorni in Lab"), ("Spain", 30.0, "Verdi Anna con 30 giorni in ")]

    # 150 is no percentage, so the checks stop the run after their results are stored.
    with pytest.raises(ChecksFailed, match="student_publications: expression.grado_proprieta_dottorandi"):
        jobs.check_core_layer(store, "r1", 2024)
    results = {(r.object_name, r.check_name): r.status for r in store.read_log("validation_results").collect()}
    assert len(results) == 59
    assert results[("students", "unique.matricola_dottorando")] == "PASS"
    rejected = jobs.quarantine_rejects(store)
    assert rejected["attivita_interne"] == 1
    assert store.read("quarantine", "rejected_attivita_interne").first().reasons == ["data_esame"]
    jobs.build_core_layer(store, {"corsi": ["cod_ins", "anno"]}, latest_enrolments=True, per_teacher=True)
    assert store.read("core", "students_courses").count() == 1
    assert "teacher" in store.read("core", "course_details").columns
    control = jobs.check_control_tables(store, "r2").collect()
    assert len(control) == 7 and {r.status for r in control} == {"PASS"}


def test_candidates_and_validation(spark):
    good = {"is_current_phd": True, "evidence": "e", "current_employer": None}
    texts = {
        "bare": json.dumps(good), "fenced": f"a\n```json\n{json.dumps(good)}\n```\n{{}}", "prose": f"so {json.dumps(good)} done",
        "array": "[1]", "no evidence": '{"is_current_phd": true}', "null flag": '{"is_current_phd": null, "evidence": "e"}',
        "yes": '{"is_current_phd": "yes", "evidence": "e"}', "number": '{"is_current_phd": true, "evidence": "e", "current_title": 3}',
        "junk": "no {json} here",
    }
    df = spark.createDataFrame(list(texts.items()), "k string, response_text string")
    rows = {r.k: r for r in validated(df).collect()}
    assert {k for k, r in rows.items() if r.validated} == {"bare", "fenced", "prose"}
    assert rows["fenced"].is_current_phd is True and rows["fenced"].evidence == "e"
    assert rows["array"].validation_errors == "not an object"
    assert rows["junk"].validation_errors == "not valid JSON"
    assert rows["yes"].validation_errors == "is_current_phd: not a boolean" and rows["yes"].is_current_phd is None
    assert df.select(json_candidate(df.response_text)).count() == len(texts)


def test_a_failing_call_stays_with_its_document(spark):
    asked = spark.createDataFrame([(str(i), "h", f"p{i}") for i in range(20)], "document_id string, input_hash_sha256 string, prompt string")

    def predict(prompts):
        if any(p == "p7" for p in prompts):
            raise RuntimeError("boom")
        return [p.upper() for p in prompts]

    rows = {r.document_id: (r.response_text, r.error_message) for r in call(asked, predict).collect()}
    assert rows.pop("7") == (None, "boom")
    assert rows == {str(i): (f"P{i}", None) for i in range(20) if i != 7}


def test_a_hanging_call_costs_its_deadline_only(spark):
    asked = spark.createDataFrame([(str(i), "h", f"p{i}") for i in range(24)], "document_id string, input_hash_sha256 string, prompt string")

    def predict(prompts):
        if "p7" in prompts:
            time.sleep(600)
        if "p9" in prompts:
            return ["one answer too many"] * (len(prompts) + 1)
        return [p.upper() for p in prompts]

    started = time.monotonic()
    limits = Limits(timeout=0.5, tries=2, batch=6, workers=2)
    found = call(asked, predict, limits, tasks=2)
    rows = {r.document_id: r for r in found.collect()}
    assert time.monotonic() - started < 60
    assert rows["7"].error_message == "no answer within 0.5 s" and rows["7"].latency_ms >= 1000
    assert rows["9"].error_message == "2 answers to 1 prompts"
    assert {i: rows[i].response_text for i in rows} == {str(i): None if i in (7, 9) else f"P{i}" for i in range(24)}
    assert found.rdd.getNumPartitions() == 2


def test_tries_wait_longer_each_time(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr("recordmill.operators.deadline.time.sleep", waits.append)

    def predict(texts):
        calls.append(texts)
        if len(calls) < 4:
            raise ValueError("not yet")
        return ["yes"]

    (answer,) = ask_all(predict, ["x"], Limits(tries=5, backoff=1.0, max_backoff=1.5))
    assert (answer.text, waits) == ("yes", [1.0, 1.5, 1.5])


def test_the_call_log_is_written_by_many_tasks_and_seen_whole(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    columns = [f.split()[0] for f in LOGS["llm_calls"].split(", ")]
    row = dict.fromkeys(columns) | {"run_id": "r", "validated": True}
    rows = spark.createDataFrame([tuple((row | {"document_id": str(i)}).values()) for i in range(40)], LOGS["llm_calls"])
    commit = Store.commit
    monkeypatch.setattr(Store, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        store.append_log("llm_calls", rows)
    assert store.read_log("llm_calls").count() == 0
    monkeypatch.setattr(Store, "commit", commit)
    store.append_log("llm_calls", rows.repartition(5, "document_id"))
    assert store.read_log("llm_calls").count() == 40
    parts = [p for p in (tmp_path / "store" / "etl" / "llm_calls").rglob("*.parquet")]
    assert len(parts) > 2


def test_a_worker_is_handed_few_long_prompts_at_a_time(spark):
    asked = spark.range(24).selectExpr("cast(id as string) document_id", "'h' input_hash_sha256", "repeat('x', 1048576) prompt")

    def size(texts):
        return [str(sum(map(len, texts)))] * len(texts)

    answers = [int(r.response_text) for r in call(asked, size, tasks=1).select("response_text").collect()]
    assert len(answers) == 24 and max(answers) <= 8 << 20
