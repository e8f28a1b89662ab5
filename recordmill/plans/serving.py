"""Serving layer: the twenty parameterised dashboard queries and their variables.

Parameters are typed Python values that become literals in the plan; they are
never pasted into SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.clean import text_of_all
from recordmill.operators.lists import text_list
from recordmill.operators.reshape import years_to_rows

MINIMUM_DAYS = (0, 30, 60, 90, 120, 150, 180)


def _equals(df: DataFrame, column: str, value: int) -> Column:
    """The value in the column's own type, so that the test reaches the scan and prunes partitions."""
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def _in(df: DataFrame, column: str, values: Sequence) -> Column:
    kind = df.schema[column].dataType
    return F.col(column).isin([F.lit(v).cast(kind) for v in values])


def _hours(mart: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    grouped = text_list(
        mart,
        keys,
        F.col("corsi_ore"),
        [F.col(c) for c in order],
        "\n\n",
        "corsi_ore",
        [F.sum(c).cast("decimal(18,2)").alias(c) for c in ("ore_hard", "ore_soft")],
    )
    total = F.coalesce("ore_hard", F.lit(0)) + F.coalesce("ore_soft", F.lit(0))
    return grouped.orderBy(total.desc(), *keys)


def training_hours_by_cycle(ore_di_formazione: DataFrame, ciclo: int) -> DataFrame:
    chosen = ore_di_formazione.where(_equals(ore_di_formazione, "ciclo", ciclo))
    return _hours(chosen, ["matricola", "cognome", "nome", "ciclo"], ["anno"])


def training_hours_by_cycle_and_year(ore_di_formazione: DataFrame, ciclo: int, anno: int) -> DataFrame:
    return ore_di_formazione.where(_equals(ore_di_formazione, "ciclo", ciclo) & _equals(ore_di_formazione, "anno", anno)).withColumn(
        "anno", F.col("anno").cast("string")
    )


def training_hours_by_year(ore_di_formazione: DataFrame, anno: int) -> DataFrame:
    chosen = ore_di_formazione.where(_equals(ore_di_formazione, "anno", anno)).withColumn("anno", F.col("anno").cast("string"))
    return _hours(chosen, ["matricola", "cognome", "nome", "anno"], ["ciclo"])


def _publications(mart: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    grouped = text_list(
        mart,
        keys,
        F.col("titles"),
        [F.col(c) for c in order],
        "; ",
        "Titles",
        [F.sum("publication_count").alias("Publication Count")],
    )
    return grouped.orderBy(F.desc("Publication Count"), *keys)


def publications_by_year(pubblicazione: DataFrame, anno: int) -> DataFrame:
    chosen = pubblicazione.where(_equals(pubblicazione, "anno", anno)).withColumn("anno", F.col("anno").cast("string"))
    return _publications(chosen, ["matricola", "cognome", "nome", "anno"], ["ciclo"])


def publications_by_cycle(pubblicazione: DataFrame, ciclo: int) -> DataFrame:
    chosen = pubblicazione.where(_equals(pubblicazione, "ciclo", ciclo))
    return _publications(chosen, ["matricola", "cognome", "nome", "ciclo"], ["anno"])


def publication_kinds_by_cycle(pubblicazione_dettaglio: DataFrame, ciclo: int) -> DataFrame:
    return pubblicazione_dettaglio.where(_equals(pubblicazione_dettaglio, "ciclo", ciclo))


def publications_by_cycle_and_year(pubblicazione: DataFrame, ciclo: int, anno: int) -> DataFrame:
    return pubblicazione.where(_equals(pubblicazione, "ciclo", ciclo) & _equals(pubblicazione, "anno", anno))


def supervisor_publications_by_year(pubblicazione_tutori: DataFrame, anno: int) -> DataFrame:
    return pubblicazione_tutori.where(_equals(pubblicazione_tutori, "anno", anno))


def job_status_by_cycles(stato_lavorativo: DataFrame, cicli: Sequence[str]) -> DataFrame:
    return stato_lavorativo.where(_in(stato_lavorativo, "ciclo", cicli))


def hours_by_kind(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int) -> DataFrame:
    return distribuzione_di_ore.where(
        _in(distribuzione_di_ore, "ciclo", cicli) & (F.col("anno") == F.lit(anno))
    ).withColumn("anno", F.col("anno").cast("string"))


def _ranking(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int, hours: str) -> DataFrame:
    return (
        hours_by_kind(distribuzione_di_ore, cicli, anno)
        .select("matricola", "nome", "cognome", "ciclo", "anno", hours)
        .orderBy(F.desc(hours), "matricola", "ciclo", "cognome", "nome")
    )


def lecture_hours_ranking(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int) -> DataFrame:
    return _ranking(distribuzione_di_ore, cicli, anno, "hour_les")


def exercise_hours_ranking(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int) -> DataFrame:
    return _ranking(distribuzione_di_ore, cicli, anno, "hour_ex")


def lab_hours_ranking(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int) -> DataFrame:
    return _ranking(distribuzione_di_ore, cicli, anno, "hour_lab")


def tutoring_hours_ranking(distribuzione_di_ore: DataFrame, cicli: Sequence[str], anno: int) -> DataFrame:
    return _ranking(distribuzione_di_ore, cicli, anno, "hour_tut")


def enrolled_and_passed(
    iscritti_superati: DataFrame, anno: int, insegnamenti: Sequence[str] | None = None
) -> DataFrame:
    """Enrolled against passed in one year, for chosen courses or for all."""
    chosen = iscritti_superati
    if insegnamenti is not None:
        chosen = chosen.where(_in(chosen, "nome_insegnamento", insegnamenti))
    rows = years_to_rows(chosen, ["cod_ins", "nome_insegnamento", "docente"])
    return (
        rows.where(F.col("anno") == F.lit(anno))
        .drop("anno")
        .withColumnRenamed("iscritti", "iscritt")
        .orderBy(F.col("iscritt").desc_nulls_last(), "cod_ins", "nome_insegnamento", "docente")
    )


def mobility_list(mobilita: DataFrame, cicli: Sequence[str], anni: Sequence[int]) -> DataFrame:
    return mobilita.where(_in(mobilita, "ciclo", cicli) & _in(mobilita, "anno", anni))


def mobility_count(mobilita: DataFrame, anni: Sequence[int], minimum_days: int) -> DataFrame:
    chosen = mobilita.where(_in(mobilita, "anno", anni) & (F.col("durata_giorni") > minimum_days))
    return chosen.agg(F.count("*").alias("count"))


def _duration_by_country(chosen: DataFrame) -> DataFrame:
    detail = text_of_all(
        F.col("cognome"), F.lit(" "), F.col("nome"), F.lit(" con "), F.col("durata_giorni").cast("string"),
        F.lit(" giorni"), F.lit(" in "), F.col("ente"),
    )
    grouped = text_list(
        chosen,
        ["paese"],
        detail,
        [F.col("cognome"), F.col("nome")],
        " | ",
        "dettaglio",
        [F.avg("durata_giorni").alias("durata"), F.count("*").cast("string").alias("studenti")],
    )
    return grouped.select(
        "paese", F.col("durata").alias("durata_giorni"), "studenti", "dettaglio"
    ).orderBy(F.col("durata_giorni").desc_nulls_last(), "paese")


def duration_by_country_for_cycles(mobilita: DataFrame, cicli: Sequence[str], minimum_days: int) -> DataFrame:
    return _duration_by_country(
        mobilita.where(_in(mobilita, "ciclo", cicli) & (F.col("durata_giorni") > minimum_days))
    )


def duration_by_country_for_years(mobilita: DataFrame, anni: Sequence[int], minimum_days: int) -> DataFrame:
    return _duration_by_country(
        mobilita.where(_in(mobilita, "anno", anni) & (F.col("durata_giorni") > minimum_days))
    )


def variable_values(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Distinct values of a column, for a dashboard variable."""
    values = df.select(column).distinct()
    return values.orderBy(F.col(column).asc_nulls_last()) if ordered else values


# Variable -> (core table, column).
VARIABLES = {
    "training.ciclo": ("students", "ciclo"),
    "training.anno": ("attivita_interne", "anno"),
    "hours.ciclo": ("students", "ciclo"),
    "hours.anno": ("students_courses", "anno"),
    "courses.anno": ("students_courses", "anno"),
    "courses.nome_insegnamento": ("filtered_iu_stats", "nome_insegnamento"),
    "mobility.ciclo": ("mobilita_internazionale_con_studenti", "ciclo"),
    "mobility.anno": ("mobilita_internazionale_con_studenti", "anno"),
}
