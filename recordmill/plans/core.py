"""Core layer: typed tables with one row per business key.

Each function takes a staging DataFrame (text columns plus ``loaded_at`` and
``source_file``) and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import clean
from recordmill.functions.keys import surrogate_key
from recordmill.operators.dedup import keep_latest
from recordmill.operators.resolve import fill_id_by_unique_name

LINEAGE = ("loaded_at", "source_file")

Typing = Callable[[Column], Column]
text = clean.blank_to_null
hours = partial(clean.decimal_comma, precision=10, scale=2)
points = partial(clean.decimal_comma, precision=12, scale=2)
hours_or_zero = partial(clean.decimal_or_zero, precision=10, scale=2)
factor = partial(clean.decimal_comma, precision=8, scale=4)
share = partial(clean.decimal_comma, precision=6, scale=2)
indicator = partial(clean.signed_decimal, precision=12, scale=4)

# Years carried as columns by the course statistics source.
STATISTIC_YEARS = (2025, 2024, 2023, 2022)
STATISTIC_METRICS = ("iscritti", "superati", "iis_iscritti", "iis_superati")


def _fields(**kinds) -> dict[str, tuple[str, Typing]]:
    return {name: kind if isinstance(kind, tuple) else (name, kind) for name, kind in kinds.items()}


# How every column of a core table is typed: name -> (staging column, typing).
FIELDS: dict[str, dict[str, tuple[str, Typing]]] = {
    "students": _fields(
        matricola_dottorando=text,
        matricola_dipendente_docente=text,
        email=clean.lower_text,
        cognome=text,
        nome=text,
        ciclo=text,
        tutore=text,
        co_tutore=text,
        status=text,
        ore_soft_skills=hours,
        ore_hard_skills=hours,
        punti_soft_skills=points,
        punti_hard_skills=points,
        punti_attivita_fuorisede=points,
        punti_totali=points,
    ),
    "attivita_interne": _fields(
        matricola=text,
        ciclo=text,
        cod_ins=text,
        nome_insegnamento=text,
        ore=hours_or_zero,
        ore_riconosciute=hours_or_zero,
        voto=text,
        coeff_voto=hours_or_zero,
        data_esame=clean.date_dmy,
        tipo_form=text,
        liv_esame=text,
        tipo_attivita=text,
        punti=hours_or_zero,
    ),
    "attivita_esterne": _fields(
        matricola=text,
        ciclo=text,
        denominazione=text,
        ore_dichiarate=hours,
        ore_riconosciute=hours,
        ore_calcolate=hours,
        coeff_voto=factor,
        punti=points,
        tipo_form=text,
        tipo_richiesta=text,
        liv_esame=text,
        data_attivita=clean.date_dmy,
        data_convalida=clean.date_dmy,
    ),
    "attivita_fuori_sede": _fields(
        matricola=text,
        ciclo=text,
        denominazione=text,
        luogo=text,
        ente=text,
        periodo=text,
        data_autorizzazione=clean.date_dmy_loose,
        data_aut_pagamento=clean.date_dmy_loose,
        data_attestaz=clean.date_dmy_loose,
        data_convalida=clean.date_dmy_loose,
    ),
    "publications": _fields(
        titolo=text,
        anno=clean.strict_year,
        tipo=text,
        rivista=text,
        autori=text,
        convegno=text,
        referee=text,
        indicatore_r=indicator,
        errore_val=indicator,
    ),
    "student_publications": _fields(
        matricola=text,
        titolo=text,
        grado_proprieta_dottorandi=share,
        punteggio=points,
        grado_proprieta=share,
    ),
    "students_courses": _fields(
        cod_ins=text,
        anno=clean.strict_year,
        matricola=text,
        cognome=text,
        nome=text,
        cod_insegnamento_col=text,
        cod_corso_dottorato=text,
        periodo_didattico=text,
        stato=text,
    ),
    "course_details": _fields(
        cod_ins=text,
        anno=clean.strict_year,
        type=text,
        teacher=text,
        status=text,
        ssd=text,
        h_les=hours,
        h_ex=hours,
        h_lab=hours,
        h_tut=hours,
        years_teaching=clean.strict_int,
    ),
    "journal_details": _fields(
        matricola=text,
        ciclo=text,
        cognome=text,
        nome=text,
        titolo=text,
        issn=clean.code_chars,
        anno=clean.strict_year,
        quartile=clean.quartile,
    ),
    "ore_formazione": _fields(
        matricola=text,
        ciclo=text,
        cognome=text,
        nome=text,
        tutor=text,
        ore_soft_skill=hours,
        ore_hard_skill=hours,
        ore_totali=hours,
    ),
    "stat_pubb": _fields(
        matricola=text,
        ciclo=text,
        cognome=text,
        nome=text,
        numero_journal=clean.strict_int,
        numero_conferenze=clean.strict_int,
        numero_capitoli=clean.strict_int,
        numero_poster=clean.strict_int,
        numero_abstract=clean.strict_int,
        numero_brevetti=clean.strict_int,
    ),
    "collaborazioni_dettaglio": _fields(
        matricola=("matricola_dott", text),
        cognome=text,
        nome=text,
        ciclo=text,
        tutor=text,
        ore=hours,
        tipo_attivita=text,
        materia=text,
        docente=text,
        corso_di_laurea=text,
    ),
    "filtered_iu_stats": _fields(
        cod_ins=text,
        nome_insegnamento=text,
        docente=text,
        **{f"{m}_{y}": clean.strict_int for y in STATISTIC_YEARS for m in STATISTIC_METRICS},
    ),
    "mobilita_internazionale_con_studenti": _fields(
        matricola=text,
        cognome=text,
        nome=text,
        tutore=text,
        ciclo=text,
        tipo=text,
        paese=text,
        ente=text,
        periodo=text,
        durata_giorni=clean.strict_int,
        anno=clean.strict_year,
        data_autorizzazione=clean.date_dmy,
        data_pagamento=clean.date_dmy,
    ),
}


def typed(staging: DataFrame, name: str) -> DataFrame:
    """The cleaned columns of a core table, one row per staging row."""
    cleaned = [kind(F.col(raw)).alias(out) for out, (raw, kind) in FIELDS[name].items()]
    return staging.select(*cleaned, *LINEAGE)


def rejected_values(staging: DataFrame, name: str) -> DataFrame:
    """Staging rows with a value that could not be typed, and the columns at fault."""
    checks = [
        F.when(clean.rejected(raw, typed_value), F.lit(out))
        for out, (raw, kind) in FIELDS[name].items()
        for typed_value in [_strictly(kind)(F.col(raw))]
        if kind is not text and kind is not clean.lower_text
    ]
    reasons = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return staging.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def _strictly(kind: Typing) -> Typing:
    """The typing without its default, so that a defaulted value counts as rejected."""
    if kind is hours_or_zero:
        return lambda c: F.when(clean.blank_to_null(c) == "-", F.lit(0).cast("decimal(10,2)")).otherwise(hours(c))
    return kind


def latest_load_only(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the newest load per key, for sources that re-send whole files."""
    newest = staging.groupBy(*keys).agg(F.max("loaded_at").alias("__newest"))
    return (
        staging.join(newest, list(keys))
        .where(F.col("loaded_at") == F.col("__newest"))
        .select(*staging.columns)
    )


def _by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return keep_latest(df, keys).drop(*LINEAGE)


def _by_hash(df: DataFrame, hashed: Sequence[str]) -> DataFrame:
    return keep_latest(df.withColumn("id", surrogate_key(hashed)), ["id"], same=hashed).drop(*LINEAGE)


def students(staging: DataFrame) -> DataFrame:
    return _by_key(typed(staging, "students"), ["matricola_dottorando"])


def attivita_interne(staging: DataFrame) -> DataFrame:
    rows = typed(staging, "attivita_interne").withColumn("anno", clean.year_of("data_esame"))
    return _by_hash(
        rows,
        [
            "matricola", "ciclo", "cod_ins", "nome_insegnamento", "data_esame", "tipo_form", "liv_esame",
            "tipo_attivita", "ore", "ore_riconosciute", "voto", "coeff_voto", "punti",
        ],
    )


def attivita_esterne(staging: DataFrame) -> DataFrame:
    return _by_hash(
        typed(staging, "attivita_esterne"),
        [
            "matricola", "ciclo", "denominazione", "tipo_form", "tipo_richiesta", "liv_esame", "data_attivita",
            "data_convalida", "ore_dichiarate", "ore_riconosciute", "ore_calcolate", "coeff_voto", "punti",
        ],
    )


def attivita_fuori_sede(staging: DataFrame) -> DataFrame:
    return _by_hash(typed(staging, "attivita_fuori_sede"), list(FIELDS["attivita_fuori_sede"]))


def _with_author(rows: DataFrame) -> DataFrame:
    return rows.withColumn("autore_cognome", clean.nth_part("autori", ", ", 1)).withColumn(
        "autore_nome", clean.nth_part("autori", ", ", 2)
    )


def publications(staging: DataFrame) -> DataFrame:
    return _by_key(_with_author(typed(staging, "publications")), ["titolo"])


def publication_authors(staging: DataFrame) -> DataFrame:
    """Publications at the grain (title, author): no author of a title is lost."""
    return _with_author(_by_key(typed(staging, "publications"), ["titolo", "autori"]))


def student_publications(staging: DataFrame) -> DataFrame:
    return _by_key(typed(staging, "student_publications"), ["matricola", "titolo"])


def students_courses(staging: DataFrame, latest_only: bool = False) -> DataFrame:
    """Enrolments as delivered; ``latest_only`` keeps one row per course, year and student."""
    rows = typed(staging, "students_courses")
    if latest_only:
        return keep_latest(rows, ["cod_ins", "anno", "matricola"]).drop(*LINEAGE)
    return rows.drop(*LINEAGE)


def course_details(staging: DataFrame, per_teacher: bool = False) -> DataFrame:
    """One row per course and year; ``per_teacher`` keeps one row for each teacher."""
    keys = ["cod_ins", "anno"]
    rows = typed(staging, "course_details")
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return keep_latest(rows, [*keys, "teacher"] if per_teacher else keys).drop(*LINEAGE)


def journal_details(staging: DataFrame) -> DataFrame:
    rows = typed(staging, "journal_details")
    kept = _by_hash(rows, ["matricola", "ciclo", "titolo", "issn", "anno", "quartile"])
    return kept.withColumn("issn", clean.dashed_code("issn"))


def ore_formazione(staging: DataFrame) -> DataFrame:
    return _by_hash(
        typed(staging, "ore_formazione"),
        ["matricola", "ciclo", "tutor", "ore_soft_skill", "ore_hard_skill", "ore_totali"],
    )


def stat_pubb(staging: DataFrame) -> DataFrame:
    counters = [c for c in FIELDS["stat_pubb"] if c.startswith("numero_")]
    return _by_hash(typed(staging, "stat_pubb"), ["matricola", "ciclo", *counters])


def collaborazioni_dettaglio(staging: DataFrame) -> DataFrame:
    return _by_hash(
        typed(staging, "collaborazioni_dettaglio"),
        ["matricola", "ciclo", "tutor", "tipo_attivita", "materia", "docente", "corso_di_laurea", "ore"],
    )


def filtered_iu_stats(staging: DataFrame) -> DataFrame:
    return _by_hash(typed(staging, "filtered_iu_stats"), ["cod_ins", "nome_insegnamento", "docente"])


def mobilita_internazionale_con_studenti(staging: DataFrame, core_students: DataFrame) -> DataFrame:
    filled = fill_id_by_unique_name(
        typed(staging, "mobilita_internazionale_con_studenti"),
        core_students,
        "matricola_dottorando",
        ["cognome", "nome"],
        "matricola",
        "matched_students_count",
    )
    return _by_hash(
        filled,
        [
            "matricola", "cognome", "nome", "ciclo", "tipo", "paese", "ente", "periodo", "durata_giorni", "anno",
            "data_autorizzazione", "data_pagamento",
        ],
    )


# Staging table of every core table that needs no other core table.
SOURCES: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "students": (students, "students"),
    "attivita_interne": (attivita_interne, "attivita_formative_interne"),
    "attivita_esterne": (attivita_esterne, "attivita_formative_esterne"),
    "attivita_fuori_sede": (attivita_fuori_sede, "attivita_formative_fuorisede"),
    "publications": (publications, "pubblicazioni"),
    "student_publications": (student_publications, "pubblicazioni"),
    "students_courses": (students_courses, "corsi"),
    "course_details": (course_details, "dettaglio_corso"),
    "journal_details": (journal_details, "journal_details"),
    "ore_formazione": (ore_formazione, "ore_formazione"),
    "stat_pubb": (stat_pubb, "stat_pubb"),
    "collaborazioni_dettaglio": (collaborazioni_dettaglio, "collaborazioni_dettaglio"),
    "filtered_iu_stats": (filtered_iu_stats, "filtered_iu_stats"),
}


def build_core(staging: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """All core tables, given a reader of staging tables by name."""
    tables = {name: build(staging(source)) for name, (build, source) in SOURCES.items()}
    mobility = "mobilita_internazionale_con_studenti"
    tables[mobility] = mobilita_internazionale_con_studenti(staging(mobility), tables["students"])
    return tables
