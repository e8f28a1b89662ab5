"""Plans and names: filters reach the scan, building runs no job, homonyms do not multiply."""

import pytest
from pyspark.sql import functions as F

from recordmill.functions import clean
from recordmill.operators.enrich import predict_by_rules
from recordmill.operators.resolve import match_by_unique_name
from recordmill.plans import marts, serving


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "panel",
    [
        lambda m: serving.training_hours_by_cycle(m, 35),
        lambda m: serving.training_hours_by_cycle_and_year(m, 35, 2024),
        lambda m: serving.training_hours_by_year(m, 2024),
    ],
)
def test_panel_filters_reach_the_scan(spark, tmp_path, panel):
    rows = [("1", "A", "B", c, y, 1, 2, "x") for c in ("34", "35") for y in (2023, 2024)]
    names = "matricola string, cognome string, nome string, ciclo string, anno int, ore_hard decimal(18,2), ore_soft decimal(18,2), corsi_ore string"
    spark.createDataFrame(rows, "a string, b string, c string, d string, e int, f int, g int, h string").toDF(
        "matricola", "cognome", "nome", "ciclo", "anno", "ore_hard", "ore_soft", "corsi_ore"
    ).selectExpr(*[f"cast({n.split()[0]} as {n.split()[1]}) as {n.split()[0]}" for n in names.split(", ")]).write.parquet(str(tmp_path / "m"))
    found = panel(spark.read.parquet(str(tmp_path / "m")))
    assert "EqualTo(" in plan(found).split("PushedFilters")[1]
    assert found.count() > 0


def test_building_a_list_mart_runs_no_job(spark):
    core = spark.createDataFrame([("1", "35", 2024, "Hard", "c", 1, 1)], "matricola string, ciclo string, anno int, tipo_form string, nome_insegnamento string, ore_riconosciute int, punti int")
    people = spark.createDataFrame([("1", "A", "B")], "matricola_dottorando string, cognome string, nome string")
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    marts.ore_di_formazione(core, people)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_an_ordered_list_mart_makes_its_lists_once(spark):
    core = spark.sql(
        "select * from values ('1', '35', 2024, 'Hard', 'c', 1.5, 1), ('1', '35', 2024, 'Soft', 'b', 2.0, 1), "
        "('2', '35', 2024, 'Hard', 'c', 9.0, 1) as t(matricola, ciclo, anno, tipo_form, nome_insegnamento, ore_riconosciute, punti)"
    )
    people = spark.sql("select * from values ('1', 'A', 'B') as t(matricola_dottorando, cognome, nome)")
    mart = marts.ore_di_formazione(core, people, ordered=True)
    assert [(r.matricola, r.cognome, r.corsi_ore.count("TIPO")) for r in mart.collect()] == [("2", None, 1), ("1", "A", 2)]
    # read from above: the sort reads a shuffle of finished lists, for its ranges and for its rows
    text = plan(mart)
    assert "BroadcastHashJoin" in text
    assert text.index("rangepartitioning") < text.index("hashpartitioning(matricola") < text.index("listagg(")


def test_one_name_on_a_third_of_the_rows(spark):
    left = spark.createDataFrame([(i, "Hot Name" if i % 3 == 0 else f"n {i}") for i in range(300)], "id int, name string")
    right = spark.createDataFrame([(i, "hot  name" if i % 3 == 0 else f"N {i}") for i in range(300)], "doc int, title string")
    got = match_by_unique_name(left, clean.full_name_key("name"), right, clean.full_name_key("title"), "docs")
    assert got.count() == 300
    assert {(r.doc, r.docs) for r in got.where(F.col("name") == "Hot Name").collect()} == {(None, 100)}
    assert all(r.doc == r.id and r.docs == 1 for r in got.where(F.col("name") != "Hot Name").collect())


def test_rules_survive_a_bar_and_give_the_month():
    answer = predict_by_rules(["Roles:\n- PhD | Student | Poli | Nov 2023 - Present | Turin"])[0]
    assert '"current_title": "PhD | Student"' in answer and '"since_month": "2023-11"' in answer
