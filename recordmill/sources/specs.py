"""Input contract: one ``SourceSpec`` per kind of file."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Fixed texts of the input files.
EMPTY_MARKER = "Nessun dato disponibile nella tabella"
NO_TEACHER = "Nessuna collaborazione prevista"

# Raw texts that mean "no value" (the defaults of the common data-frame CSV reader).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed patterns of the input's paths, which carry keys: pattern with one group, matched on the whole path.
STUDENT_IN_NAME = r"/(\d+)_"
CYCLE_IN_FOLDER = r"/cicli/(\d+)/"
COURSE_IN_NAME = r"/(?:dettaglio_corso_)?([A-Za-z0-9]+)_\d{4}\.csv\z"
YEAR_IN_NAME = r"/(?:dettaglio_corso_)?[A-Za-z0-9]+_(\d{4})\.csv\z"


@dataclass(frozen=True)
class SourceSpec:
    """How files of one kind become rows of one staging table.

    ``separator=None`` finds the delimiter of each file from its header line.
    ``strict`` needs every mapped header; otherwise only the ``required`` ones, and a
    missing column is null. ``post`` is a user transformation of the staged frame.
    """

    name: str
    table: str
    glob: str
    separator: str | None
    columns: dict[str, str]
    strict: bool = False
    required: tuple[str, ...] = ()
    path_fields: dict[str, str] = field(default_factory=dict)
    exclude: str | None = None
    drop_marker: tuple[str, str] | None = None
    explode: tuple[str, str] | None = None
    null_tokens: tuple[str, ...] = NULL_TOKENS
    empty_marker: str = EMPTY_MARKER
    post: Callable[[DataFrame], DataFrame] | None = None

    @property
    def must_have(self) -> tuple[str, ...]:
        return tuple(self.columns) if self.strict else self.required

    @property
    def staged_columns(self) -> list[str]:
        return ["run_id", "source_file", "loaded_at", *self.path_fields, *self.columns.values()]


def _same(*names: str) -> dict[str, str]:
    """Headers whose column name is the header with blanks as underscores."""
    return {n: n.replace(" ", "_") for n in names}


_OF_STUDENT = {"matricola": STUDENT_IN_NAME, "ciclo": CYCLE_IN_FOLDER}
_OF_COURSE = {"cod_ins": COURSE_IN_NAME, "anno": YEAR_IN_NAME}

# Where the files of each source lie, their delimiter, and the column
# that each of their headers becomes.
SPECS = {
    s.name: s
    for s in (
        SourceSpec(
            "students", "students", "cicli/*/0_students_info.csv", ";",
            {
                "Matricola dottorando/a:": "matricola_dottorando",
                "Matricola da dipendente/docente:": "matricola_dipendente_docente",
                "Email": "email", "Cognome": "cognome", "Nome": "nome", "Ciclo": "ciclo", "Tutore": "tutore",
                "Co-tutore": "co_tutore", "Status": "status", "Ore Soft Skills": "ore_soft_skills",
                "Ore Hard Skills": "ore_hard_skills", "Punti Soft Skills": "punti_soft_skills",
                "Punti Hard Skills": "punti_hard_skills", "Punti Attività fuorisede": "punti_attivita_fuorisede",
                "Punti totali": "punti_totali",
            },
        ),
        SourceSpec(
            "internal_activities", "attivita_formative_interne", "cicli/*/*_attivita_formative_interne.csv", ",",
            {
                "Cod Ins.": "cod_ins", "Nome insegnamento": "nome_insegnamento", "Ore": "ore",
                "Ore riconosciute": "ore_riconosciute", "Voto": "voto", "Coeff. voto": "coeff_voto",
                "Data esame": "data_esame", "Tipo form.": "tipo_form", "Liv. Esame": "liv_esame",
                "Tipo attività": "tipo_attivita", "Punti": "punti",
            },
            path_fields=_OF_STUDENT,
        ),
        SourceSpec(
            "external_activities", "attivita_formative_esterne", "cicli/*/*_attivita_formative_esterne.csv", "\t",
            {
                "Denominazione": "denominazione", "Ore dichiarate": "ore_dichiarate",
                "Ore riconosciute": "ore_riconosciute", "Ore calcolate": "ore_calcolate",
                "Coeff. voto": "coeff_voto", "Punti": "punti", "Tipo form.": "tipo_form",
                "Tipo Richiesta": "tipo_richiesta", "Liv. Esame": "liv_esame", "Data attività": "data_attivita",
                "Data convalida": "data_convalida",
            },
            path_fields=_OF_STUDENT,
        ),
        SourceSpec(
            "offsite_activities", "attivita_formative_fuorisede", "cicli/*/*_attivita_formative_fuorisede.csv", "\t",
            {
                "Denominazione": "denominazione", "Luogo": "luogo", "Ente": "ente", "Periodo": "periodo",
                "Data autorizzazione": "data_autorizzazione", "Data aut.pagamento": "data_aut_pagamento",
                "Data attestaz.": "data_attestaz", "Data convalida": "data_convalida",
            },
            path_fields=_OF_STUDENT,
        ),
        SourceSpec(
            "publications", "pubblicazioni", "cicli/*/*_pubblicazioni.csv", "\t",
            {
                "Anno": "anno", "Tipo": "tipo", "Titolo": "titolo", "Rivista": "rivista", "Autori": "autori",
                "Convegno": "convegno", "Referee": "referee",
                "Grado proprietà dottorandi": "grado_proprieta_dottorandi", "Punteggio": "punteggio",
                "Grado proprietà": "grado_proprieta", "Indicatore R": "indicatore_r", "Errore Val.": "errore_val",
            },
            required=("Autori",), path_fields=_OF_STUDENT, explode=("autori", ";"),
        ),
        SourceSpec(
            "enrolments", "corsi", "corsi/*_*.csv", "\t",
            {
                "matricola": "matricola", "cognome": "cognome", "nome": "nome",
                "codInsegnamento": "cod_insegnamento_col", "codCorsoDottorato": "cod_corso_dottorato",
                "PeriodoDidattico": "periodo_didattico", "-": "dash_col", "stato": "stato",
            },
            path_fields=_OF_COURSE, exclude=r"/dettaglio_corso_[^/]*\z",
        ),
        SourceSpec(
            "course_details", "dettaglio_corso", "corsi/dettaglio_corso_*_*.csv", "\t",
            {
                "Type": "type", "Teacher": "teacher", "Status": "status", "SSD": "ssd", "h.Les": "h_les",
                "h.Ex": "h_ex", "h.Lab": "h_lab", "h.Tut": "h_tut", "Years teaching": "years_teaching",
            },
            required=("Teacher",), path_fields=_OF_COURSE, drop_marker=("teacher", NO_TEACHER),
        ),
        SourceSpec(
            "journal_details", "journal_details", "journal_details/journal_details_*.csv", ",",
            _same("matricola", "cognome", "nome", "titolo", "rivista", "issn", "anno", "quartile"),
            path_fields={"ciclo": r"/journal_details_(\d+)\.csv\z"},
        ),
        SourceSpec(
            "training_hours", "ore_formazione", "ore_formazione/ore_formazione_ciclo_*.csv", ",",
            _same("matricola", "cognome", "nome", "tutor", "ore soft skill", "ore hard skill", "ore totali"),
            path_fields={"ciclo": r"/ore_formazione_ciclo_(\d+)\.csv\z"},
        ),
        SourceSpec(
            "publication_counters", "stat_pubb", "stat_pubb/stat_pubb_*.csv", ",",
            _same(
                "matricola", "cognome", "nome", "numero_journal", "numero_conferenze", "numero_capitoli",
                "numero_poster", "numero_abstract", "numero_brevetti", *[f"quartile_{i}" for i in range(1, 16)],
            ),
            path_fields={"ciclo": r"/stat_pubb_(\d+)\.csv\z"},
        ),
        SourceSpec(
            "collaborations", "collaborazioni_dettaglio", "collaborazioni_dettaglio.csv", ",",
            {
                "Matricola Dott": "matricola_dott", "Cognome": "cognome", "Nome": "nome", "Ciclo": "ciclo",
                "Tutor": "tutor", "Ore": "ore", "Tipo Attività": "tipo_attivita", "Materia": "materia",
                "Docente": "docente", "Corso di Laurea": "corso_di_laurea",
            },
            strict=True,
        ),
        SourceSpec(
            "course_statistics", "filtered_iu_stats", "filtered_IU_stats.csv", ",",
            {
                "Cod.Ins": "cod_ins", "Nome Insegnamento": "nome_insegnamento", "Docente": "docente",
                **{
                    f"{m}_{y}": f"{m}_{y}".lower()
                    for y in (2025, 2024, 2023, 2022)
                    for m in ("Iscritti", "Superati", "IIS_Iscritti", "IIS_Superati")
                },
            },
            strict=True,
        ),
        SourceSpec(
            "mobility", "mobilita_internazionale_con_studenti", "mobilita_internazionale_con_studenti.csv", ",",
            _same(
                "matricola", "cognome", "nome", "tutore", "ciclo", "tipo", "paese", "ente", "periodo",
                "durata_giorni", "anno", "data_autorizzazione", "data_pagamento",
            ),
            strict=True,
        ),
    )
}
