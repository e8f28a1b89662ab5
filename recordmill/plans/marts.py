"""Mart layer: denormalised tables for serving.

A mart has one row per key; lists of text are one cell each (see ``operators.lists``).
A stored table has no order, so the functions sort only when asked to (``ordered=True``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import clean
from recordmill.operators.dedup import keep_first
from recordmill.operators.lists import text_list
from recordmill.operators.resolve import exclude_by_initial, match_by_name, match_by_unique_name

# Fixed texts of the job-status mart.
NO_SECTION = "No experience section in linkedin page"
UNKNOWN = "Unknown"

PERSON = ("cognome", "nome")


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _people(students: DataFrame, *columns: str) -> DataFrame:
    return students.select(F.col("matricola_dottorando").alias("matricola"), *columns)


def _sorted(df: DataFrame, ordered: bool, first: Column, ties: list[str]) -> DataFrame:
    return df.orderBy(first, *ties) if ordered else df


def ore_di_formazione(attivita_interne: DataFrame, students: DataFrame, ordered: bool = False) -> DataFrame:
    """Hard and soft training hours per student, cycle and year, with the course list."""
    credited = attivita_interne.where(F.col("punti") > 0)
    counts = F.col("tipo_form").isin("Hard", "Soft") & (F.col("ore_riconosciute") != 0)
    kind = F.when(counts, F.col("tipo_form"))
    amount = F.when(counts, F.col("ore_riconosciute").cast("string"))
    course = F.concat(
        F.lit("TIPO: "), F.coalesce(kind, F.lit("N/A")), F.lit(", CORSO: "), F.col("nome_insegnamento"),
        F.lit(", ORE: "), F.coalesce(amount, F.lit("0")),
    )

    def total_of(form: str) -> Column:
        return money(F.coalesce(F.sum(F.when(F.col("tipo_form") == form, F.col("ore_riconosciute"))), F.lit(0)))

    grouped = text_list(
        credited,
        ["matricola", "ciclo", "anno"],
        course,
        [F.col("nome_insegnamento")],
        "\n\n",
        "corsi_ore",
        [total_of("Hard").alias("ore_hard"), total_of("Soft").alias("ore_soft")],
    )
    if ordered:
        # a sort reads its input twice, for its ranges and for its rows; after this shuffle the lists are made once
        grouped = grouped.repartition("matricola")
    mart = grouped.join(_people(students, *PERSON), "matricola", "left").select(
        "matricola", *PERSON, "ciclo", "anno", "ore_hard", "ore_soft", "corsi_ore"
    )
    total = F.coalesce("ore_hard", F.lit(0)) + F.coalesce("ore_soft", F.lit(0))
    return _sorted(mart, ordered, total.desc_nulls_last(), ["matricola", "ciclo", "anno"])


def pubblicazione(
    students: DataFrame, student_publications: DataFrame, publications: DataFrame, ordered: bool = False
) -> DataFrame:
    """Number and titles of publications per student and year; students without any are left out."""
    titles = publications.where(F.col("titolo") != "").select("titolo", "anno")
    written = student_publications.select("matricola", "titolo").join(titles, "titolo")
    grouped = text_list(
        written,
        ["matricola", "anno"],
        F.col("titolo"),
        [],
        "; ",
        "titles",
        [F.count("*").alias("publication_count")],
    )
    mart = grouped.join(_people(students, *PERSON, "ciclo"), "matricola").select(
        "matricola", *PERSON, "ciclo", "anno", "publication_count", "titles"
    )
    return _sorted(mart, ordered, F.desc("publication_count"), ["matricola", "anno"])


# Column titles of the counters in the publication-kinds mart.
KINDS = {
    "numero_journal": "Journal",
    "numero_conferenze": "Conferenze",
    "numero_capitoli": "Capitoli",
    "numero_poster": "Poster",
    "numero_abstract": "Abstract",
    "numero_brevetti": "Brevetti",
}


def pubblicazione_dettaglio(
    stat_pubb: DataFrame, students: DataFrame, ordered: bool = False, unique: bool = False
) -> DataFrame:
    """Publication counters by kind; the id comes from the exact name, once per homonym.

    With ``unique`` a row keeps its grain: the id is given only where one student has the name, and ``students`` is
    the number of those who have it. Homonyms on both sides then never multiply.
    """
    shown = [F.col(c).alias(t) for c, t in KINDS.items()]
    people = _people(students, *PERSON)
    if unique:
        people = people.groupBy(*PERSON).agg(F.count("*").alias("students"), F.min("matricola").alias("__id"))
        found = stat_pubb.drop("matricola").join(people, list(PERSON), "left")
        one = F.when(F.col("students") == 1, F.col("__id")).alias("matricola")
        mart = found.select(one, *PERSON, "ciclo", *shown, F.coalesce("students", F.lit(0)).alias("students"))
    else:
        mart = stat_pubb.drop("matricola").join(people, list(PERSON), "left").select("matricola", *PERSON, "ciclo", *shown)
    total = sum((F.coalesce(F.col(t), F.lit(0)).cast("bigint") for t in KINDS.values()), F.lit(0))
    return _sorted(mart, ordered, total.desc(), ["cognome", "nome", "ciclo", "matricola"])


def pubblicazione_tutori(publications: DataFrame, students: DataFrame, ordered: bool = False) -> DataFrame:
    """Publications of authors who are no students, per author label and year."""
    others = exclude_by_initial(publications, "autore_cognome", "autore_nome", students, "cognome", "nome")
    label = F.concat(F.col("autore_cognome"), F.lit(" "), clean.first_initial("autore_nome"), F.lit("."))
    mart = text_list(
        others.select(label.alias("autore"), "anno", "titolo"),
        ["autore", "anno"],
        F.col("titolo"),
        [],
        "; ",
        "titoli",
        [F.count("*").alias("n_pub")],
    )
    return _sorted(mart, ordered, F.desc("n_pub"), ["autore", "anno"])


HOURS = {"hour_les": "h_les", "hour_ex": "h_ex", "hour_lab": "h_lab", "hour_tut": "h_tut"}


def distribuzione_di_ore(
    students: DataFrame, students_courses: DataFrame, course_details: DataFrame, ordered: bool = False
) -> DataFrame:
    """Lecture, exercise, lab and tutoring hours per student and year.

    Repeated enrolments are counted before the join, so a student with very many
    rows reaches it as one row per course and year.
    """
    enrolled = (
        students_courses.where(F.col("matricola").isNotNull())
        .groupBy("matricola", "anno", "cod_ins")
        .agg(F.count("*").alias("times"))
    )
    details = course_details.select(
        "cod_ins", "anno", F.col("cod_ins").alias("found"), *HOURS.values()
    )
    taught = enrolled.join(details, ["cod_ins", "anno"], "left")
    grouped = text_list(
        taught,
        ["matricola", "anno"],
        F.col("found"),
        [],
        ", ",
        "insegnamenti",
        [F.sum(F.col(h) * F.col("times")).cast("decimal(18,2)").alias(out) for out, h in HOURS.items()],
    )
    zero = F.lit(0).cast("decimal(18,2)")
    mart = (
        _people(students, *PERSON, "ciclo")
        .join(grouped, "matricola", "left")
        .select(
            "matricola",
            "nome",
            "cognome",
            "ciclo",
            "anno",
            *[F.coalesce(F.col(h), zero).alias(h) for h in HOURS],
            "insegnamenti",
        )
    )
    total = sum((F.col(h) for h in list(HOURS)[1:]), F.col("hour_les"))
    return _sorted(mart, ordered, total.desc(), ["matricola", "anno"])


def stato_lavorativo(
    students: DataFrame,
    status: DataFrame,
    roles: DataFrame,
    no_section: str = NO_SECTION,
    unknown: str = UNKNOWN,
    unique: bool = False,
) -> DataFrame:
    """Latest job status per student, found by the name in the document's file name.

    With ``unique`` a status is given only where one student and one document have the name, and ``documents`` is the
    number of documents with it; otherwise homonyms meet as often as they can.

    The newest known month wins. Documents without role records have no file name
    and can match nobody, so they are left out before the window.
    """
    files = roles.where(F.col("source_file").isNotNull()).select("document_id", "source_file").distinct()
    latest = keep_first(
        status.join(files, "document_id"),
        ["source_file"],
        [F.col("since_month").desc_nulls_last(), F.col("document_id").asc()],
    )
    filled = latest.select(
        clean.nth_part("source_file", " _", 1).alias("nome_cognome"),
        "is_current_phd",
        *[
            F.coalesce(clean.blank_to_null(c), F.lit(no_section)).alias(c)
            for c in ("current_employer", "current_title", "since_month")
        ],
        "evidence",
    )
    people = _people(students, "nome", "cognome", "ciclo")
    names = (
        people, clean.full_name_key(F.concat(F.col("nome"), F.lit(" "), F.col("cognome"))),
        filled, clean.full_name_key("nome_cognome"),
    )
    joined = match_by_unique_name(*names, "documents") if unique else match_by_name(*names)

    def known(column: str) -> Column:
        return F.when(F.col("nome_cognome").isNull(), F.lit(unknown)).otherwise(F.col(column))

    return joined.select(
        "matricola",
        "nome",
        "cognome",
        "ciclo",
        "is_current_phd",
        known("current_employer").alias("employer"),
        known("current_title").alias("title"),
        known("since_month").alias("since"),
        F.col("evidence").alias("linkedin_exact_phrasing"),
        *(["documents"] if unique else []),
    )


def mobilita_internazionale(mobility: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct mobility records."""
    shown = ["matricola", "cognome", "nome", "durata_giorni", "ciclo", "anno", "paese", "tipo", "ente"]
    mart = mobility.select(*shown, "tutore").distinct().select(*shown)
    return _sorted(mart, ordered, F.col("durata_giorni").desc_nulls_last(), shown)


def iscritti_superati(filtered_iu_stats: DataFrame) -> DataFrame:
    return filtered_iu_stats


MART_NAMES = (
    "ore_di_formazione", "pubblicazione", "pubblicazione_dettaglio", "pubblicazione_tutori", "distribuzione_di_ore",
    "stato_lavorativo", "mobilita_internazionale", "iscritti_superati",
)


def build_marts(core: dict[str, DataFrame], status: DataFrame, roles: DataFrame) -> dict[str, DataFrame]:
    """All marts, given the core tables, the enriched status and the role records."""
    return {
        "ore_di_formazione": ore_di_formazione(core["attivita_interne"], core["students"]),
        "pubblicazione": pubblicazione(core["students"], core["student_publications"], core["publications"]),
        "pubblicazione_dettaglio": pubblicazione_dettaglio(core["stat_pubb"], core["students"]),
        "pubblicazione_tutori": pubblicazione_tutori(core["publications"], core["students"]),
        "distribuzione_di_ore": distribuzione_di_ore(
            core["students"], core["students_courses"], core["course_details"]
        ),
        "stato_lavorativo": stato_lavorativo(core["students"], status, roles),
        "mobilita_internazionale": mobilita_internazionale(core["mobilita_internazionale_con_studenti"]),
        "iscritti_superati": iscritti_superati(core["filtered_iu_stats"]),
    }
