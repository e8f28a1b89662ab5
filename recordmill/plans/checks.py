"""The checks of the core layer."""

from __future__ import annotations

from recordmill.operators.quality import Check, allowed, expression, not_null, relationship, unique

STUDENT = ("students", "matricola_dottorando")
STAFF = ("students", "matricola_dipendente_docente")
# Tables whose key is the hashed ``id``.
HASHED = (
    "attivita_esterne", "attivita_fuori_sede", "attivita_interne", "collaborazioni_dettaglio",
    "filtered_iu_stats", "journal_details", "mobilita_internazionale_con_studenti", "ore_formazione", "stat_pubb",
)
# Tables whose ``matricola`` must be a student's.
OF_STUDENTS = (
    "attivita_esterne", "attivita_fuori_sede", "attivita_interne", "collaborazioni_dettaglio", "ore_formazione",
    "student_publications", "students_courses",
)


def core_checks(this_year: int) -> list[Check]:
    """The rules, with the current year as a parameter so that runs repeat."""
    upper = this_year + 1
    checks: list[Check] = []
    for table in HASHED:
        checks += [*not_null(table, "id"), unique(table, "id")]
    for table in OF_STUDENTS:
        checks += [*not_null(table, "matricola"), relationship(table, "matricola", *STUDENT)]
    for table in ("journal_details", "stat_pubb"):
        checks += not_null(table, "matricola", severity="warn")
        checks.append(relationship(table, "matricola", *STAFF, severity="warn"))
    checks += [
        *not_null("students", "matricola_dottorando"),
        unique("students", "matricola_dottorando"),
        expression("students", "ore_soft_skills", "ore_soft_skills is null or ore_soft_skills >= 0"),
        expression("students", "ore_hard_skills", "ore_hard_skills is null or ore_hard_skills >= 0"),
        *not_null("publications", "titolo"),
        unique("publications", "titolo"),
        *not_null("student_publications", "titolo"),
        relationship("student_publications", "titolo", "publications", "titolo"),
        unique("student_publications", "matricola", "titolo"),
        expression("student_publications", "punteggio", "punteggio is null or punteggio >= 0"),
        *[
            expression("student_publications", c, f"{c} is null or ({c} between 0 and 100)")
            for c in ("grado_proprieta", "grado_proprieta_dottorandi")
        ],
        *not_null("students_courses", "cod_ins", "anno"),
        *not_null("course_details", "cod_ins", "anno"),
        *not_null("attivita_interne", "cod_ins", severity="warn"),
        *not_null("filtered_iu_stats", "cod_ins"),
        relationship("filtered_iu_stats", "cod_ins", "course_details", "cod_ins", severity="warn"),
        *[
            expression(t, "anno", f"anno is null or (anno between 1900 and {upper})", severity="warn")
            for t in ("publications", "journal_details")
        ],
        expression("students_courses", "anno", f"anno between 1990 and {upper}", severity="warn"),
        expression(
            "attivita_fuori_sede",
            "data_autorizzazione",
            f"data_autorizzazione is null or year(data_autorizzazione) between 2000 and {upper}",
            severity="warn",
        ),
    ]
    return checks


# Allowed values of the status columns in the control tables.
CONTROL_CHECKS = [
    allowed("runs", "status", ("RUNNING", "SUCCESS", "FAILED")),
    allowed("file_manifest", "source_type", ("csv",)),
    allowed("file_manifest", "status", ("NEW", "LOADED", "SKIPPED", "QUARANTINED", "FAILED")),
    allowed("step_metrics", "status", ("RUNNING", "SUCCESS", "FAILED")),
    allowed("validation_results", "status", ("PASS", "FAIL", "WARN")),
    allowed("documents", "status", ("NEW", "PARSED", "ENRICHED", "NEEDS_REVIEW", "FAILED")),
    allowed("llm_calls", "status", ("SUCCESS", "FAILED")),
]
