"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of
from workload.tables import TABLES

SAMPLE = (
    "core_students", "core_publications", "mart_ore_di_formazione", "mart_distribuzione_di_ore", "mart_pubblicazione_tutori",
    "mart_stato_lavorativo", "panel_training_hours_by_year", "panel_enrolled_and_passed_chosen", "panel_duration_by_country_for_years",
    "variable_mobility_anno", "quality_orphans", "unique_name_fill", "document_records", "enrich_validate", "enrich_prompts",
    "ingest_roundtrip", "stream_unique_events",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    own = [m for m in entry_points.MODULES if m not in entry_points.EXTRA]
    assert {q for m in own for q in m.QUERIES} == {q for m in own for q in m.ORACLE}


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry_points.queries()[name](spark, sf_dir)
    cur = duck.execute(entry_points.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    assert want[1]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["matricola", "cognome", "nome", "ciclo", "anno", "ore_hard", "ore_soft", "corsi_ore"]
    assert df.count() > 0
