"""Typing rules, keep-latest, resolution, quality and reshaping on small inputs."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordmill.functions import clean
from recordmill.functions.keys import surrogate_key
from recordmill.operators import quality as dq
from recordmill.operators.dedup import keep_latest
from recordmill.operators.reshape import drop_marker, explode_list, unpivot_years, years_to_rows
from recordmill.operators.resolve import exclude_by_initial, fill_id_by_unique_name
from recordmill.plans import checks, core


def typed(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", kind("v").alias("x")).orderBy("i").collect()]


def D(x):
    return Decimal(x)


@pytest.mark.parametrize(
    ("kind", "values", "wanted"),
    [
        (clean.blank_to_null, [" a ", "  ", "", None, "\t"], ["a", None, None, None, "\t"]),
        (clean.lower_text, [" A@B ", " "], ["a@b", None]),
        (lambda c: clean.decimal_comma(c, 10, 2), ["12,5", "12.5", "-", "abc", "1.005", " ", "99999999999"],
         [D("12.50"), D("12.50"), None, None, D("1.01"), None, None]),
        (lambda c: clean.decimal_or_zero(c, 10, 2), ["1,5", "-", "", None, "x"], [D("1.50"), D("0.00"), D("0.00"), D("0.00"), D("0.00")]),
        (lambda c: clean.signed_decimal(c, 12, 4), ["-1,5", "1.", "1e3", "5\n"], [D("-1.5000"), None, None, None]),
        (clean.strict_int, ["12", "-1", "1.0", "99999999999", "7\n"], [12, None, None, None, None]),
        (clean.strict_year, ["2024", "24", "20245", "20x4"], [2024, None, None, None]),
        (clean.date_dmy, ["3/4/2024", "03/04/2024", "31/02/2024", "2024-04-03", ""],
         [datetime.date(2024, 4, 3), datetime.date(2024, 4, 3), None, None, None]),
        (clean.date_dmy_loose, [" 3/4/2024 ", "garbage"], [datetime.date(2024, 4, 3), None]),
        (lambda c: clean.dashed_code(clean.code_chars(c)), ["1234-567x", "12345678", "123", " "], ["1234-567X", "1234-5678", "123", None]),
        (clean.quartile, ["Q1", "q4", "5", "2", "Q12", None], [1, 4, None, 2, None, None]),
        (clean.name_key, ["  De   Rossi ", None], ["de rossi", ""]),
        (lambda c: clean.nth_part(c, ", ", 2), ["Rossi, Mario", "Rossi", None], ["Mario", "", None]),
        (clean.first_initial, [".A.B", "x", ""], ["A", "x", ""]),
        (lambda c: clean.text_of_all(F.col(c), F.lit("!")), ["a", None], ["a!", "!"]),
    ],
)
def test_typing(spark, kind, values, wanted):
    assert typed(spark, kind, values) == wanted


def test_dates_are_cast_and_equal_those_of_the_pattern(spark):
    days = ["0", "1", "01", "9", "28", "29", "30", "31", "32", "001", "", "x"]
    months = ["0", "1", "02", "2", "4", "12", "13", ""]
    years = ["0000", "0001", "1582", "1900", "2000", "2023", "2024", "9999", "24", "02024", "2024/1", "2024 "]
    rows = [(f"{d}/{m}/{y}",) for d in days for m in months for y in years] + [(None,), ("/",), ("1/1",), ("1/1/2024\n",)]
    texts = spark.createDataFrame(rows, "t string")
    trimmed = clean.blank_to_null("t")
    wanted = F.when(trimmed.rlike(clean.DAY_MONTH_YEAR), F.try_to_date(trimmed, "d/M/yyyy"))
    got = texts.select("t", clean.date_dmy("t").alias("got"), wanted.alias("wanted"))
    assert got.where("not (got <=> wanted)").select("t").collect() == []
    assert got.where("got is not null").count() > 100
    plan = texts.select(clean.date_dmy("t"))._jdf.queryExecution().executedPlan().toString()
    assert "d/M/yyyy" not in plan


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("a", None)], "x string, y string")
    ids = [r.id for r in df.select(surrogate_key(["x", "y"]).alias("id")).collect()]
    assert len(set(ids)) == 3


def test_keep_latest_does_not_depend_on_partitions(spark):
    rows = [(k, f"2024-01-0{t}", f"f{f}", v) for k in range(30) for t in (1, 2) for f in (1, 2) for v in "ba"]
    rows += [(1, "2024-01-02", "f2", "a")] * 500 + [(99, None, "f", "x"), (99, "2020-01-01", "a", "y")]
    df = spark.createDataFrame(rows, "k int, loaded_at string, source_file string, v string")
    results = [sorted(map(tuple, keep_latest(df.repartition(n), ["k"]).collect())) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]
    assert results[0][0] == (0, "2024-01-02", "f2", "a") and results[0][-1] == (99, "2020-01-01", "a", "y")


def test_keep_latest_prunes_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as loaded_at", "'f' as source_file")
    plan = keep_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unique_names_only(spark):
    people = spark.createDataFrame([("1", "Rossi", "Mario"), ("2", "Verdi", "Anna"), ("3", " verdi", "ANNA"), ("4", None, "X")], "id string, c string, n string")
    rows = spark.createDataFrame([(None, "ROSSI ", "mario"), (None, "Verdi", "Anna"), ("7", "Verdi", "Anna"), (None, None, "X")], "m string, c string, n string")
    got = fill_id_by_unique_name(rows, people, "id", ["c", "n"], "m", "cnt").collect()
    assert sorted([(r.c, r.m, r.cnt) for r in got], key=str) == sorted(
        [("ROSSI ", "1", 1), ("Verdi", None, 2), ("Verdi", "7", 2), (None, None, None)], key=str)


def test_exclude_by_initial(spark):
    known = spark.createDataFrame([(" Rossi", ".m"), ("Bianchi", None)], "c string, n string")
    rows = spark.createDataFrame([("rossi", "Mario"), ("Rossi", "Anna"), ("Bianchi", "X"), (None, "M"), ("Rossi", "")], "c string, n string")
    got = {(r.c, r.n) for r in exclude_by_initial(rows, "c", "n", known, "c", "n").collect()}
    assert got == {("Rossi", "Anna"), ("Bianchi", "X"), (None, "M"), ("Rossi", "")}


def test_reshaping(spark):
    df = spark.createDataFrame([(1, "a; b;"), (2, None)], "k int, v string")
    assert [tuple(r) for r in explode_list(df, "v", ";").orderBy("k", "v").collect()] == [(1, ""), (1, "a"), (1, "b"), (2, None)]
    assert [r.k for r in drop_marker(df, "v", "a; b;").collect()] == [2]
    wide = spark.createDataFrame([("c", 1, 2, 3)], "k string, a_2024 int, a_2023 int, b_b_2024 int")
    assert sorted(tuple(r) for r in unpivot_years(wide, ["k"]).collect()) == [("c", "a", 2023, 2), ("c", "a", 2024, 1), ("c", "b_b", 2024, 3)]
    assert sorted(tuple(r) for r in years_to_rows(wide, ["k"]).collect()) == [("c", 2023, 2, None), ("c", 2024, 1, 3)]


def test_quality_counts_and_severity(spark):
    child = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, None), (None, "z", 3), (None, "z", 3)], "k int, p string, n int")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    rules = [
        *dq.not_null("c", "k", "p", severity="warn"), dq.unique("c", "k"), dq.unique("c", "k", "p"), dq.relationship("c", "p", "q", "p"),
        dq.expression("c", "n", "n >= 0"), dq.allowed("c", "p", ("a", "b", "z")),
    ]
    out = dq.run_checks({"c": child, "q": parent}, rules, "r", "2024-01-01")
    got = {r.check_name: (r.status, r.observed_value) for r in out.collect()}
    assert got == {
        "not_null.k": ("WARN", 2), "not_null.p": ("WARN", 1), "unique.k": ("FAIL", 1), "unique.k_p": ("PASS", 0),
        "relationship.p": ("FAIL", 2), "expression.n": ("FAIL", 1), "allowed.p": ("PASS", 0)}
    with pytest.raises(dq.ChecksFailed, match="unique.k"):
        dq.enforce(out)
    dq.enforce(out.where("status <> 'FAIL'"))


def test_core_checks_are_complete():
    rules = checks.core_checks(2024)
    kinds = [c.kind for c in rules]
    assert len(rules) == 59 and sum(c.severity == "warn" for c in rules) == 10
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 27, "unique": 12, "relationship": 11, "expression": 9}
    assert {c.table for c in rules} == {*core.SOURCES, "mobilita_internazionale_con_studenti"}


def test_all_checks_read_a_table_once(spark, tmp_path):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z"), (9, "a"), (9, "a")], "k int, v string")
    parent = spark.createDataFrame([(1, 1.5), (2, -2.0), (2, 3.0)], "id long, x double")
    for name, df in (("c", child), ("p", parent)):
        df.write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in "cp"}
    rules = [
        *dq.not_null("c", "k", "v"), dq.unique("c", "k"), dq.unique("c", "k", "v"), dq.unique("p", "id", severity="warn"),
        dq.relationship("c", "k", "p", "id"), dq.expression("p", "x", "x > 0"), dq.allowed("c", "v", ("a", "b", "z")),
    ]
    out = dq.run_checks(tables, rules, "r", "2024-01-01")
    got = {(r.object_name, r.check_name): (r.status, r.observed_value) for r in out.collect()}
    assert got == {
        ("c", "not_null.k"): ("FAIL", 1), ("c", "not_null.v"): ("FAIL", 1), ("c", "unique.k"): ("FAIL", 2),
        ("c", "unique.k_v"): ("FAIL", 1), ("p", "unique.id"): ("WARN", 1), ("c", "relationship.k"): ("FAIL", 2),
        ("p", "expression.x"): ("FAIL", 1), ("c", "allowed.v"): ("PASS", 0),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2
    with pytest.raises(KeyError, match="q"):
        dq.run_checks(tables, [dq.relationship("c", "k", "q", "id")], "r", "2024-01-01")


def test_keys_are_told_apart_by_every_value(spark):
    rows = [("a", "b:c", 1), ("a:b", "c", 2), ("a", "b:c", 3), (None, "c", 4), (None, "c", 4)]
    t = spark.createDataFrame(rows, "x string, y string, n int").withColumn("at", F.timestamp_micros(F.col("n").cast("long")))
    results = dq.run_checks({"t": t}, [dq.unique("t", "x", "y"), dq.unique("t", "at"), dq.unique("t", "n")], "r", "2024-01-01 00:00:00")
    assert {r.check_name: r.observed_value for r in results.collect()} == {"unique.x_y": 1, "unique.at": 1, "unique.n": 1}
