"""Queries for the core, mart and serving layers over derived staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordmill.operators.ranking import with_position
from recordmill.plans import core, marts, serving
from workload.oracle import CLEAN_NAME, METRICS, OR_DEFAULT, sql, whole
from workload.staging import staging

QUERIES, ORACLE = {}, {}

MOBILITY = "mobilita_internazionale_con_studenti"


def core_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == MOBILITY:
        return core.mobilita_internazionale_con_studenti(
            staging(spark, sf_dir, MOBILITY), core_table(spark, sf_dir, "students")
        )
    build, source = core.SOURCES[name]
    return build(staging(spark, sf_dir, source))


# mart -> (function, core tables it takes)
MART_INPUTS = {
    "ore_di_formazione": (marts.ore_di_formazione, ["attivita_interne", "students"]),
    "pubblicazione": (marts.pubblicazione, ["students", "student_publications", "publications"]),
    "pubblicazione_dettaglio": (marts.pubblicazione_dettaglio, ["stat_pubb", "students"]),
    "pubblicazione_tutori": (marts.pubblicazione_tutori, ["publications", "students"]),
    "distribuzione_di_ore": (marts.distribuzione_di_ore, ["students", "students_courses", "course_details"]),
    "mobilita_internazionale": (marts.mobilita_internazionale, [MOBILITY]),
    "iscritti_superati": (marts.iscritti_superati, ["filtered_iu_stats"]),
}


def mart(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    if name == "stato_lavorativo":
        return marts.stato_lavorativo(
            core_table(spark, sf_dir, "students"),
            staging(spark, sf_dir, "phd_status"),
            staging(spark, sf_dir, "work_experience_raw"),
            **options,
        )
    build, inputs = MART_INPUTS[name]
    tables = [core_table(spark, sf_dir, t) for t in inputs]
    return build(*tables, **options)


def _short(name: str) -> str:
    return {MOBILITY: "mobilita", "mobilita_internazionale": "mobilita"}.get(name, name)


for _name in [*core.SOURCES, MOBILITY]:
    QUERIES[f"core_{_name}"] = lambda spark, d, n=_name: core_table(spark, d, n)
    ORACLE[f"core_{_name}"] = whole(f"core_{_short(_name)}")

QUERIES["core_publication_authors"] = lambda spark, d: core.publication_authors(staging(spark, d, "pubblicazioni"))
ORACLE["core_publication_authors"] = whole("core_publication_authors")
QUERIES["core_students_courses_latest"] = lambda spark, d: core.students_courses(
    staging(spark, d, "corsi"), latest_only=True
)
ORACLE["core_students_courses_latest"] = whole("core_students_courses_latest")
QUERIES["core_course_teachers"] = lambda spark, d: core.course_details(
    staging(spark, d, "dettaglio_corso"), per_teacher=True
)
ORACLE["core_course_teachers"] = whole("core_course_teachers")
QUERIES["core_latest_load_only"] = lambda spark, d: core.students_courses(
    core.latest_load_only(staging(spark, d, "corsi"), ["matricola"])
)
ORACLE["core_latest_load_only"] = sql(
    """select nullif(trim(cod_ins), '') as cod_ins,
       case when regexp_matches(trim(anno), '^\\d{4}$') then cast(trim(anno) as integer) end as anno,
       nullif(trim(matricola), '') as matricola, nullif(trim(cognome), '') as cognome, nullif(trim(nome), '') as nome,
       nullif(trim(cod_insegnamento_col), '') as cod_insegnamento_col,
       nullif(trim(cod_corso_dottorato), '') as cod_corso_dottorato,
       nullif(trim(periodo_didattico), '') as periodo_didattico, nullif(trim(stato), '') as stato
    from stg_corsi qualify loaded_at = max(loaded_at) over (partition by matricola)""",
    "stg_corsi",
)

_SORTED = ("ore_di_formazione", "pubblicazione", "pubblicazione_dettaglio", "pubblicazione_tutori",
           "distribuzione_di_ore", "mobilita_internazionale")
for _name in [*MART_INPUTS, "stato_lavorativo"]:
    _options = {"ordered": True} if _name in _SORTED else {}
    QUERIES[f"mart_{_name}"] = lambda spark, d, n=_name, o=_options: mart(spark, d, n, **o)
    ORACLE[f"mart_{_name}"] = whole(f"mart_{_short(_name)}")


QUERIES["mart_pubblicazione_dettaglio_unique"] = lambda spark, d: mart(spark, d, "pubblicazione_dettaglio", unique=True)
ORACLE["mart_pubblicazione_dettaglio_unique"] = sql(
    """select case when n = 1 then person end as matricola, c.cognome, c.nome, c.ciclo, numero_journal as "Journal",
              numero_conferenze as "Conferenze", numero_capitoli as "Capitoli", numero_poster as "Poster",
              numero_abstract as "Abstract", numero_brevetti as "Brevetti", coalesce(n, 0) as students
    from core_stat_pubb c
    left join (select cognome, nome, count(*) as n, min(matricola_dottorando) as person from core_students group by all) p
           on p.cognome = c.cognome and p.nome = c.nome""",
    "core_stat_pubb", "core_students",
)


def _panel(name: str, mart_name: str, build, query: str) -> None:
    QUERIES[f"panel_{name}"] = lambda spark, d: build(mart(spark, d, mart_name))
    ORACLE[f"panel_{name}"] = sql(query, f"mart_{_short(mart_name)}")


CYCLE, YEAR = 35, 1998
CYCLES, CALENDAR = ["33", "35", "38"], [1997, 1999]

_TRAINING = """select matricola, cognome, nome, {key}, cast(sum(ore_hard) as decimal(18,2)) as ore_hard,
    cast(sum(ore_soft) as decimal(18,2)) as ore_soft,
    string_agg(corsi_ore, chr(10) || chr(10) order by {order}, corsi_ore) as corsi_ore
    from (select * replace (cast(anno as varchar) as anno), anno as year from mart_ore_di_formazione) where {test}
    group by matricola, cognome, nome, {key}"""
_panel("training_hours_by_cycle", "ore_di_formazione", lambda m: serving.training_hours_by_cycle(m, CYCLE),
       _TRAINING.format(key="ciclo", order="year", test=f"cast(ciclo as int) = {CYCLE}"))
_panel("training_hours_by_cycle_and_year", "ore_di_formazione",
       lambda m: serving.training_hours_by_cycle_and_year(m, CYCLE, YEAR),
       f"select * replace (cast(anno as varchar) as anno) from mart_ore_di_formazione "
       f"where anno = {YEAR} and cast(ciclo as int) = {CYCLE}")  # fmt: skip
_panel("training_hours_by_year", "ore_di_formazione", lambda m: serving.training_hours_by_year(m, YEAR),
       _TRAINING.format(key="anno", order="ciclo", test=f"year = {YEAR}"))
_PUBLISHED = """select matricola, cognome, nome, {key}, cast(sum(publication_count) as bigint) as "Publication Count",
    string_agg(titles, '; ' order by {order}, titles) as "Titles"
    from (select * replace (cast(anno as varchar) as anno), anno as year from mart_pubblicazione) where {test}
    group by matricola, cognome, nome, {key}"""
_panel("publications_by_year", "pubblicazione", lambda m: serving.publications_by_year(m, YEAR),
       _PUBLISHED.format(key="anno", order="ciclo", test=f"year = {YEAR}"))
_panel("publications_by_cycle", "pubblicazione", lambda m: serving.publications_by_cycle(m, CYCLE),
       _PUBLISHED.format(key="ciclo", order="year", test=f"cast(ciclo as int) = {CYCLE}"))
_panel("publication_kinds_by_cycle", "pubblicazione_dettaglio",
       lambda m: serving.publication_kinds_by_cycle(m, CYCLE),
       f"select * from mart_pubblicazione_dettaglio where cast(ciclo as int) = {CYCLE}")
_panel("publications_by_cycle_and_year", "pubblicazione",
       lambda m: serving.publications_by_cycle_and_year(m, CYCLE, YEAR),
       f"select * from mart_pubblicazione where cast(ciclo as int) = {CYCLE} and anno = {YEAR}")
_panel("supervisor_publications_by_year", "pubblicazione_tutori",
       lambda m: serving.supervisor_publications_by_year(m, YEAR),
       f"select * from mart_pubblicazione_tutori where anno = {YEAR}")
_IN_CYCLES = "ciclo in (" + ", ".join(f"'{c}'" for c in CYCLES) + ")"
_IN_YEARS = "anno in (" + ", ".join(str(y) for y in CALENDAR) + ")"
_panel("job_status_by_cycles", "stato_lavorativo", lambda m: serving.job_status_by_cycles(m, CYCLES),
       f"select * from mart_stato_lavorativo where {_IN_CYCLES}")
_panel("hours_by_kind", "distribuzione_di_ore", lambda m: serving.hours_by_kind(m, CYCLES, YEAR),
       f"select * replace (cast(anno as varchar) as anno) from mart_distribuzione_di_ore "
       f"where {_IN_CYCLES} and anno = {YEAR}")  # fmt: skip
for _title, _fn, _hour in (
    ("lecture", serving.lecture_hours_ranking, "hour_les"),
    ("exercise", serving.exercise_hours_ranking, "hour_ex"),
    ("lab", serving.lab_hours_ranking, "hour_lab"),
    ("tutoring", serving.tutoring_hours_ranking, "hour_tut"),
):
    _panel(f"{_title}_hours_ranking", "distribuzione_di_ore", lambda m, f=_fn: f(m, CYCLES, YEAR),
           f"select matricola, nome, cognome, ciclo, cast(anno as varchar) as anno, {_hour} "
           f"from mart_distribuzione_di_ore where {_IN_CYCLES} and anno = {YEAR}")  # fmt: skip
_COURSES = ["red widget", "small ring", "blue bolt"]
_STATISTICS = (
    "select cod_ins, nome_insegnamento, docente, "
    + ", ".join(f"{m}_2024 as {'iscritt' if m == 'iscritti' else m}" for m in METRICS)
    + " from mart_iscritti_superati"
)
_panel("enrolled_and_passed_chosen", "iscritti_superati",
       lambda m: serving.enrolled_and_passed(m, 2024, _COURSES),
       _STATISTICS + " where nome_insegnamento in (" + ", ".join(f"'{c}'" for c in _COURSES) + ")")
_panel("enrolled_and_passed_all", "iscritti_superati", lambda m: serving.enrolled_and_passed(m, 2024), _STATISTICS)
_panel("mobility_list", "mobilita_internazionale", lambda m: serving.mobility_list(m, CYCLES, CALENDAR),
       f"select * from mart_mobilita where {_IN_CYCLES} and {_IN_YEARS}")
_panel("mobility_count", "mobilita_internazionale", lambda m: serving.mobility_count(m, CALENDAR, 60),
       f'select count(*) as "count" from mart_mobilita where {_IN_YEARS} and durata_giorni > 60')
_DURATION = """select paese, avg(durata_giorni) as durata_giorni, cast(count(*) as varchar) as studenti,
    string_agg(detail, ' | ' order by cognome, nome, detail) as dettaglio
    from (select *, concat(cognome, ' ', nome, ' con ', durata_giorni, ' giorni', ' in ', ente) as detail
          from mart_mobilita where {test} and durata_giorni > 60) group by paese"""
_panel("duration_by_country_for_cycles", "mobilita_internazionale",
       lambda m: serving.duration_by_country_for_cycles(m, CYCLES, 60), _DURATION.format(test=_IN_CYCLES))
_panel("duration_by_country_for_years", "mobilita_internazionale",
       lambda m: serving.duration_by_country_for_years(m, CALENDAR, 60), _DURATION.format(test=_IN_YEARS))

for _variable, (_table, _column) in serving.VARIABLES.items():
    _key = "variable_" + _variable.replace(".", "_")
    QUERIES[_key] = lambda spark, d, t=_table, c=_column: serving.variable_values(core_table(spark, d, t), c)
    _cte = f"core_{_short(_table)}"
    ORACLE[_key] = sql(f"select distinct {_column} from {_cte}", _cte)


# The order of the ordered results, as a position column.
_TOTAL = "coalesce(ore_hard, 0) + coalesce(ore_soft, 0)"
_TIES = ", ".join(f"{c} nulls first" for c in ("matricola", "cognome", "nome", "ciclo"))
QUERIES["order_training_hours_by_cycle"] = lambda spark, d: with_position(
    serving.training_hours_by_cycle(mart(spark, d, "ore_di_formazione"), CYCLE)
).select("position", "matricola", "cognome", "nome", "ore_hard", "ore_soft")
ORACLE["order_training_hours_by_cycle"] = sql(
    f"""select row_number() over (order by {_TOTAL} desc, {_TIES}) as position, matricola, cognome, nome, ore_hard, ore_soft
    from ({_TRAINING.format(key="ciclo", order="year", test=f"cast(ciclo as int) = {CYCLE}")})""",
    "mart_ore_di_formazione",
)
_KIND_TOTAL = " + ".join(f'coalesce("{t}", 0)' for t in marts.KINDS.values())
_KIND_TIES = ", ".join(f"{c} nulls first" for c in ("cognome", "nome", "ciclo", "matricola"))
QUERIES["order_pubblicazione_dettaglio"] = lambda spark, d: with_position(mart(spark, d, "pubblicazione_dettaglio", ordered=True)).drop(
    *marts.KINDS.values()
)
ORACLE["order_pubblicazione_dettaglio"] = sql(
    f"""select row_number() over (order by {_KIND_TOTAL} desc, {_KIND_TIES}) as position, matricola, cognome, nome, ciclo
    from mart_pubblicazione_dettaglio""",
    "mart_pubblicazione_dettaglio",
)
for _title, _fn, _hour in (
    ("lecture", serving.lecture_hours_ranking, "hour_les"),
    ("exercise", serving.exercise_hours_ranking, "hour_ex"),
    ("lab", serving.lab_hours_ranking, "hour_lab"),
    ("tutoring", serving.tutoring_hours_ranking, "hour_tut"),
):
    QUERIES[f"order_{_title}_hours"] = lambda spark, d, f=_fn: with_position(f(mart(spark, d, "distribuzione_di_ore"), CYCLES, YEAR))
    ORACLE[f"order_{_title}_hours"] = sql(
        f"""select row_number() over (order by {_hour} desc nulls last, matricola nulls first, ciclo nulls first,
                cognome nulls first, nome nulls first) as position,
            matricola, nome, cognome, ciclo, cast(anno as varchar) as anno, {_hour}
        from mart_distribuzione_di_ore where {_IN_CYCLES} and anno = {YEAR}""",
        "mart_distribuzione_di_ore",
    )

# One status per student where the name is one student's and one document's.
QUERIES["mart_stato_lavorativo_unique"] = lambda spark, d: mart(spark, d, "stato_lavorativo", unique=True)
ORACLE["mart_stato_lavorativo_unique"] = sql(
    f"""select matricola_dottorando as matricola, s.nome, s.cognome, s.ciclo, is_current_phd,
        {OR_DEFAULT.format("current_employer")} as employer, {OR_DEFAULT.format("current_title")} as title,
        {OR_DEFAULT.format("since_month")} as since, evidence as linkedin_exact_phrasing,
        coalesce(f.documents, 0) as documents
    from (select *, {CLEAN_NAME.format("nome || ' ' || cognome")} as name,
                 count(*) over (partition by {CLEAN_NAME.format("nome || ' ' || cognome")}) as carriers from core_students) s
    left join (select {CLEAN_NAME.format("string_split(source_file, ' _')[1]")} as name, count(*) as documents,
                      any_value(source_file) as only_file
               from newest_status group by 1) f on f.name = s.name
    left join newest_status d on d.source_file = f.only_file and f.documents = 1 and s.carriers = 1""",
    "core_students", "newest_status",
)
