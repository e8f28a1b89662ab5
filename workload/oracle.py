"""Checking SQL: named subqueries joined into one WITH statement."""

from __future__ import annotations

from collections.abc import Sequence

from workload.staging import STAGING, staging_sql

# --- typing of raw text -----------------------------------------------------


def txt(c: str) -> str:
    return f"nullif(trim({c}), '')"


def low(c: str) -> str:
    return f"nullif(lower(trim({c})), '')"


def dec(p: int, s: int):
    return lambda c: f"try_cast(nullif(replace(trim({c}), ',', '.'), '') as decimal({p},{s}))"


def dec0(c: str) -> str:
    inner = f"nullif(replace(nullif(trim({c}), '-'), ',', '.'), '')"
    return f"coalesce(try_cast({inner} as decimal(10,2)), 0::decimal(10,2))"


def signed(c: str) -> str:
    return (
        f"case when regexp_matches(trim({c}), '^-?\\d+([.,]\\d+)?$') "
        f"then try_cast(replace(trim({c}), ',', '.') as decimal(12,4)) end"
    )


def integer(c: str) -> str:
    return f"case when regexp_matches({txt(c)}, '^\\d+$') then try_cast({txt(c)} as integer) end"


def year4(c: str) -> str:
    return f"case when regexp_matches({txt(c)}, '^\\d{{4}}$') then try_cast({txt(c)} as integer) end"


def dmy(c: str) -> str:
    return (
        f"case when regexp_matches({txt(c)}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') "
        f"then cast(try_strptime({txt(c)}, '%d/%m/%Y') as date) end"
    )


def dmy_loose(c: str) -> str:
    return f"cast(try_strptime({txt(c)}, '%d/%m/%Y') as date)"


def issn(c: str) -> str:
    return f"upper(regexp_replace({txt(c)}, '[^0-9Xx]', '', 'g'))"


def quart(c: str) -> str:
    return (
        f"case when regexp_matches({low(c)}, '^q?[1-4]$') "
        f"then try_cast(regexp_replace({low(c)}, '[^1-4]', '', 'g') as integer) end"
    )


def norm(c: str) -> str:
    return f"lower(regexp_replace(coalesce(trim({c}), ''), '\\s+', ' ', 'g'))"


def md5_key(columns: Sequence[str]) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), chr(30) || 'null')" for c in columns)
    return f"md5(concat_ws(chr(31), {parts}))"


h, p12, f84, s62 = dec(10, 2), dec(12, 2), dec(8, 4), dec(6, 2)
YEARS = (2025, 2024, 2023, 2022)
METRICS = ("iscritti", "superati", "iis_iscritti", "iis_superati")


def _many(kind, names: Sequence[str]) -> list[tuple[str, str]]:
    return [(n, kind(n)) for n in names]


# Core table -> (staging table, typed columns); below, the columns that a hashed key is made of.
CORE_COLUMNS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "students": (
        "students",
        _many(txt, (
            "matricola_dottorando", "matricola_dipendente_docente", "cognome", "nome", "ciclo", "tutore",
            "co_tutore", "status",
        ))
        + [("email", low("email"))]
        + _many(h, ("ore_soft_skills", "ore_hard_skills"))
        + _many(p12, ("punti_soft_skills", "punti_hard_skills", "punti_attivita_fuorisede", "punti_totali")),
    ),
    "attivita_interne": (
        "attivita_formative_interne",
        _many(txt, (
            "matricola", "ciclo", "cod_ins", "nome_insegnamento", "voto", "tipo_form", "liv_esame", "tipo_attivita",
        ))
        + _many(dec0, ("ore", "ore_riconosciute", "coeff_voto", "punti"))
        + [("data_esame", dmy("data_esame")), ("anno", f"cast(year({dmy('data_esame')}) as integer)")],
    ),
    "attivita_esterne": (
        "attivita_formative_esterne",
        _many(txt, ("matricola", "ciclo", "denominazione", "tipo_form", "tipo_richiesta", "liv_esame"))
        + _many(h, ("ore_dichiarate", "ore_riconosciute", "ore_calcolate"))
        + [("coeff_voto", f84("coeff_voto")), ("punti", p12("punti"))]
        + _many(dmy, ("data_attivita", "data_convalida")),
    ),
    "attivita_fuori_sede": (
        "attivita_formative_fuorisede",
        _many(txt, ("matricola", "ciclo", "denominazione", "luogo", "ente", "periodo"))
        + _many(dmy_loose, ("data_autorizzazione", "data_aut_pagamento", "data_attestaz", "data_convalida")),
    ),
    "publications": (
        "pubblicazioni",
        _many(txt, ("titolo", "tipo", "rivista", "autori", "convegno", "referee"))
        + [("anno", year4("anno"))]
        + _many(signed, ("indicatore_r", "errore_val"))
        + [
            ("autore_cognome", f"split_part({txt('autori')}, ', ', 1)"),
            ("autore_nome", f"split_part({txt('autori')}, ', ', 2)"),
        ],
    ),
    "student_publications": (
        "pubblicazioni",
        _many(txt, ("matricola", "titolo"))
        + [
            ("grado_proprieta_dottorandi", s62("grado_proprieta_dottorandi")),
            ("punteggio", p12("punteggio")),
            ("grado_proprieta", s62("grado_proprieta")),
        ],
    ),
    "students_courses": (
        "corsi",
        _many(txt, (
            "cod_ins", "matricola", "cognome", "nome", "cod_insegnamento_col", "cod_corso_dottorato",
            "periodo_didattico", "stato",
        ))
        + [("anno", year4("anno"))],
    ),
    "course_details": (
        "dettaglio_corso",
        _many(txt, ("cod_ins", "type", "teacher", "status", "ssd"))
        + [("anno", year4("anno"))]
        + _many(h, ("h_les", "h_ex", "h_lab", "h_tut"))
        + [("years_teaching", integer("years_teaching"))],
    ),
    "journal_details": (
        "journal_details",
        _many(txt, ("matricola", "ciclo", "cognome", "nome", "titolo"))
        + [("issn", issn("issn")), ("anno", year4("anno")), ("quartile", quart("quartile"))],
    ),
    "ore_formazione": (
        "ore_formazione",
        _many(txt, ("matricola", "ciclo", "cognome", "nome", "tutor")) + _many(h, ("ore_soft_skill", "ore_hard_skill", "ore_totali")),
    ),
    "stat_pubb": (
        "stat_pubb",
        _many(txt, ("matricola", "ciclo", "cognome", "nome"))
        + _many(integer, (
            "numero_journal", "numero_conferenze", "numero_capitoli", "numero_poster", "numero_abstract",
            "numero_brevetti",
        )),
    ),
    "collaborazioni_dettaglio": (
        "collaborazioni_dettaglio",
        [("matricola", txt("matricola_dott"))]
        + _many(txt, (
            "cognome", "nome", "ciclo", "tutor", "tipo_attivita", "materia", "docente", "corso_di_laurea",
        ))
        + [("ore", h("ore"))],
    ),
    "filtered_iu_stats": (
        "filtered_iu_stats",
        _many(txt, ("cod_ins", "nome_insegnamento", "docente"))
        + _many(integer, [f"{m}_{y}" for y in YEARS for m in METRICS]),
    ),
    "mobilita": (
        "mobilita_internazionale_con_studenti",
        _many(txt, ("matricola", "cognome", "nome", "tutore", "ciclo", "tipo", "paese", "ente", "periodo"))
        + [("durata_giorni", integer("durata_giorni")), ("anno", year4("anno"))]
        + _many(dmy, ("data_autorizzazione", "data_pagamento")),
    ),
}

KEYS = {
    "students": ["matricola_dottorando"],
    "publications": ["titolo"],
    "student_publications": ["matricola", "titolo"],
    "course_details": ["cod_ins", "anno"],
}
HASHED = {
    "attivita_interne": (
        "matricola", "ciclo", "cod_ins", "nome_insegnamento", "data_esame", "tipo_form", "liv_esame",
        "tipo_attivita", "ore", "ore_riconosciute", "voto", "coeff_voto", "punti",
    ),
    "attivita_esterne": (
        "matricola", "ciclo", "denominazione", "tipo_form", "tipo_richiesta", "liv_esame", "data_attivita",
        "data_convalida", "ore_dichiarate", "ore_riconosciute", "ore_calcolate", "coeff_voto", "punti",
    ),
    "attivita_fuori_sede": (
        "matricola", "ciclo", "denominazione", "luogo", "ente", "periodo", "data_autorizzazione",
        "data_aut_pagamento", "data_attestaz", "data_convalida",
    ),
    "journal_details": ("matricola", "ciclo", "titolo", "issn", "anno", "quartile"),
    "ore_formazione": ("matricola", "ciclo", "tutor", "ore_soft_skill", "ore_hard_skill", "ore_totali"),
    "stat_pubb": (
        "matricola", "ciclo", "numero_journal", "numero_conferenze", "numero_capitoli", "numero_poster",
        "numero_abstract", "numero_brevetti",
    ),
    "collaborazioni_dettaglio": (
        "matricola", "ciclo", "tutor", "tipo_attivita", "materia", "docente", "corso_di_laurea", "ore",
    ),
    "filtered_iu_stats": ("cod_ins", "nome_insegnamento", "docente"),
}
MOBILITY_HASHED = (
    "matricola", "cognome", "nome", "ciclo", "tipo", "paese", "ente", "periodo", "durata_giorni", "anno",
    "data_autorizzazione", "data_pagamento",
)


def typed_sql(name: str) -> str:
    source, columns = CORE_COLUMNS[name]
    exprs = ", ".join(f"{e} as {c}" for c, e in columns)
    return f"select {exprs}, loaded_at, source_file from stg_{source}"


def latest_sql(relation: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    rest = sorted(c for c in columns if c not in keys)
    order = ["loaded_at desc nulls last", "source_file desc nulls last"] + [f"{c} asc nulls first" for c in rest]
    return (
        f"select * exclude (loaded_at, source_file) from {relation} "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {', '.join(order)}) = 1"
    )


def _core_sql(name: str) -> str:
    columns = [c for c, _ in CORE_COLUMNS[name][1]]
    if name in KEYS:
        keys = KEYS[name]
        present = " and ".join(f"{k} is not null" for k in keys)
        return latest_sql(f"(select * from ({typed_sql(name)}) where {present})", keys, columns)
    if name in HASHED:
        keyed = f"(select *, {md5_key(HASHED[name])} as id from ({typed_sql(name)}))"
        return latest_sql(keyed, ["id"], columns)
    return f"select * exclude (loaded_at, source_file) from ({typed_sql(name)})"


# name -> (SQL, names of the subqueries it reads)
CTES: dict[str, tuple[str, list[str]]] = {
    f"stg_{name}": (staging_sql(name), []) for name in STAGING
}
for _name in CORE_COLUMNS:
    if _name != "mobilita":
        CTES[f"core_{_name}"] = (_core_sql(_name), [f"stg_{CORE_COLUMNS[_name][0]}"])
_sql, _deps = CTES["core_journal_details"]
CTES["core_journal_details"] = (
    "select * replace (case when length(issn) = 8 then substring(issn, 1, 4) || '-' || substring(issn, 5, 4) "
    f"else issn end as issn) from ({_sql})",
    _deps,
)
CTES["core_mobilita"] = (
    latest_sql(
        f"""(select *, {md5_key(MOBILITY_HASHED)} as id from (
            select m.* replace (case when m.matricola is not null then m.matricola
                                     when n.cnt = 1 then n.one end as matricola),
                   n.cnt as matched_students_count
            from ({typed_sql("mobilita")}) m
            left join (select {norm("cognome")} as cn, {norm("nome")} as nn, count(*) as cnt,
                              min(matricola_dottorando) as one
                       from core_students where cognome is not null and nome is not null group by 1, 2) n
              on {norm("m.cognome")} = n.cn and {norm("m.nome")} = n.nn))""",
        ["id"],
        [c for c, _ in CORE_COLUMNS["mobilita"][1]] + ["matched_students_count"],
    ),
    ["stg_mobilita_internazionale_con_studenti", "core_students"],
)
CTES["core_publication_authors"] = (
    latest_sql(
        f"(select * from ({typed_sql('publications')}) where titolo is not null and autori is not null)",
        ["titolo", "autori"],
        [c for c, _ in CORE_COLUMNS["publications"][1]],
    ),
    ["stg_pubblicazioni"],
)
CTES["core_students_courses_latest"] = (
    latest_sql(
        f"({typed_sql('students_courses')})",
        ["cod_ins", "anno", "matricola"],
        [c for c, _ in CORE_COLUMNS["students_courses"][1]],
    ),
    ["stg_corsi"],
)
CTES["core_course_teachers"] = (
    latest_sql(
        f"(select * from ({typed_sql('course_details')}) where cod_ins is not null and anno is not null)",
        ["cod_ins", "anno", "teacher"],
        [c for c, _ in CORE_COLUMNS["course_details"][1]],
    ),
    ["stg_dettaglio_corso"],
)

# --- marts ------------------------------------------------------------------

CTES["mart_ore_di_formazione"] = (
    """select a.*, s.cognome, s.nome
    from (select matricola, ciclo, anno,
                 cast(coalesce(sum(ore_riconosciute) filter (tipo_form = 'Hard'), 0) as decimal(18,2)) as ore_hard,
                 cast(coalesce(sum(ore_riconosciute) filter (tipo_form = 'Soft'), 0) as decimal(18,2)) as ore_soft,
                 string_agg('TIPO: ' || coalesce(kind, 'N/A') || ', CORSO: ' || nome_insegnamento || ', ORE: '
                            || if(kind is null, '0', ore_riconosciute::varchar), chr(10) || chr(10)
                            order by nome_insegnamento, coalesce(kind, 'N/A'),
                                     if(kind is null, '0', ore_riconosciute::varchar)) as corsi_ore
          from (select *, if(ore_riconosciute <> 0 and tipo_form in ('Hard', 'Soft'), tipo_form, null) as kind
                from core_attivita_interne where punti > 0)
          group by all) a
    left join (select matricola_dottorando as matricola, cognome, nome from core_students) s using (matricola)""",
    ["core_attivita_interne", "core_students"],
)
CTES["mart_pubblicazione"] = (
    """select matricola, cognome, nome, ciclo, anno, n as publication_count, titles
    from (select matricola, anno, count(*) as n, string_agg(titolo, '; ' order by titolo) as titles
          from core_publications join core_student_publications using (titolo) group by all)
    join (select matricola_dottorando as matricola, cognome, nome, ciclo from core_students) using (matricola)""",
    ["core_students", "core_student_publications", "core_publications"],
)
CTES["mart_pubblicazione_dettaglio"] = (
    """select person.matricola, c.cognome, c.nome, c.ciclo, numero_journal as "Journal", numero_conferenze as "Conferenze",
              numero_capitoli as "Capitoli", numero_poster as "Poster", numero_abstract as "Abstract",
              numero_brevetti as "Brevetti"
    from core_stat_pubb c
    left join (select matricola_dottorando as matricola, cognome, nome from core_students) person using (cognome, nome)""",
    ["core_stat_pubb", "core_students"],
)
_initial = "replace({}, '.', '')[1]"
CTES["mart_pubblicazione_tutori"] = (
    f"""select autore_cognome || ' ' || {_initial.format("autore_nome")} || '.' as autore, anno, count(*) as n_pub,
               string_agg(titolo, '; ' order by titolo) as titoli
    from (select *, trim(lower(autore_cognome)) as sn, {_initial.format("trim(lower(autore_nome))")} as gn
          from core_publications) p
    anti join (select trim(lower(cognome)) as sn, {_initial.format("trim(lower(nome))")} as gn from core_students) s
           on p.sn = s.sn and p.gn = s.gn
    group by all""",
    ["core_publications", "core_students"],
)
CTES["mart_distribuzione_di_ore"] = (
    "select matricola, nome, cognome, ciclo, t.anno, "
    + ", ".join(f"cast(coalesce({k}, 0) as decimal(18,2)) as hour_{k}" for k in ("les", "ex", "lab", "tut"))
    + """, insegnamenti
    from (select matricola_dottorando as matricola, nome, cognome, ciclo from core_students)
    left join (select matricola, e.anno, sum(h_les) as les, sum(h_ex) as ex, sum(h_lab) as lab, sum(h_tut) as tut,
                      string_agg(distinct d.cod_ins, ', ' order by d.cod_ins) as insegnamenti
               from core_students_courses e
               left join core_course_details d on d.cod_ins = e.cod_ins and d.anno = e.anno
               where matricola is not null group by matricola, e.anno) t using (matricola)""",
    ["core_students", "core_students_courses", "core_course_details"],
)
CLEAN_NAME = "array_to_string(list_filter(string_split_regex(lower({}), '\\s+'), lambda w: w <> ''), ' ')"
OR_DEFAULT = "if(d.source_file is null, 'Unknown', coalesce(nullif(trim({0}), ''), 'No experience section in linkedin page'))"
CTES["newest_status"] = (
    """with files as (select distinct document_id, source_file from stg_work_experience_raw where source_file is not null)
    select * from stg_phd_status join files using (document_id)
    qualify row_number() over (partition by source_file order by since_month desc nulls last, document_id) = 1""",
    ["stg_phd_status", "stg_work_experience_raw"],
)
CTES["mart_stato_lavorativo"] = (
    f"""select matricola_dottorando as matricola, nome, cognome, ciclo, is_current_phd,
           {OR_DEFAULT.format("current_employer")} as employer, {OR_DEFAULT.format("current_title")} as title,
           {OR_DEFAULT.format("since_month")} as since, evidence as linkedin_exact_phrasing
    from core_students s
    left join newest_status d on {CLEAN_NAME.format("s.nome || ' ' || s.cognome")}
                        = {CLEAN_NAME.format("string_split(d.source_file, ' _')[1]")}""",
    ["core_students", "newest_status"],
)
CTES["mart_mobilita"] = (
    """select matricola, cognome, nome, durata_giorni, ciclo, anno, paese, tipo, ente
    from (select distinct matricola, cognome, nome, tutore, ciclo, tipo, paese, ente, durata_giorni, anno
          from core_mobilita)""",
    ["core_mobilita"],
)
CTES["mart_iscritti_superati"] = ("select * from core_filtered_iu_stats", ["core_filtered_iu_stats"])


def sql(query: str, *reads: str) -> str:
    """``query`` with the named subqueries it needs, in order."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name not in done:
            for dep in CTES[name][1]:
                visit(dep)
            done.append(name)

    for name in reads:
        visit(name)
    parts = [f"{n} as materialized ({CTES[n][0]})" for n in done]
    return f"with {', '.join(parts)} {query}" if parts else query


def whole(name: str) -> str:
    return sql(f"select * from {name}", name)
