import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordmill.operators.lists import list_items, text_list


def expected(rows, sep):
    groups = {}
    for k, o, t in rows:
        groups.setdefault(k, []).append((o, t))
    out = {}
    for k, items in groups.items():
        kept = sorted((o, t) for o, t in items if t is not None)
        out[k] = (len(items), sep.join(t for _, t in kept) if kept else None)
    return out


def make_rows():
    rnd = random.Random(7)
    rows = [("hot", rnd.randrange(40), f"item{rnd.randrange(300)}") for _ in range(3000)]
    rows += [("hot", 5, "same") for _ in range(2000)]
    rows += [(rnd.choice("abc"), rnd.randrange(9), rnd.choice(["x", "yy", None])) for _ in range(60)]
    rows += [(None, 1, f"n{i}") for i in range(700)]
    rows += [("empty", 1, None)]
    return rows


def lists(spark, rows, **options):
    df = spark.createDataFrame(rows, "k string, o int, t string").repartition(5)
    return text_list(df, ["k"], F.col("t"), [F.col("o")], ";\n", "txt", [F.count("*").alias("n")], **options)


def test_one_row_per_group_whatever_its_size(spark):
    rows = make_rows()
    got = lists(spark, rows)
    assert got.columns == ["k", "n", "txt"]
    assert {r.k: (r.n, r.txt) for r in got.collect()} == expected(rows, ";\n")
    assert got.count() == len(expected(rows, ";\n"))


def test_items_move_as_plain_rows(spark):
    text = lists(spark, make_rows())._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_listagg") < text.index("hashpartitioning(k")


def test_a_list_beyond_a_cell_fails_and_names_its_group(spark):
    with pytest.raises(PySparkException, match='does not fit a cell: {"k":"hot"}'):
        lists(spark, make_rows(), cell_bytes=20_000).collect()


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_ranges_give_the_same_lists(spark, ranges):
    rows = make_rows()
    got = lists(spark, rows, ranges=ranges)
    assert got.columns == ["k", "n", "txt"]
    assert {r.k: (r.n, r.txt) for r in got.collect()} == expected(rows, ";\n")
    with pytest.raises(PySparkException, match='does not fit a cell: {"k":"hot"}'):
        lists(spark, rows, cell_bytes=20_000, ranges=ranges).collect()


def test_a_hot_group_is_listed_by_many_tasks_and_checked_before_it_is_joined(spark):
    rows = [(None if i % 3 else "hot", i, f"item {i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, o int, t string")
    plan = text_list(df, ["k"], F.col("t"), [F.col("o")], ",", "txt", ranges=12)
    assert [(r.k, r.txt) for r in plan.orderBy("k").collect()] == [
        (k, ",".join(t for a, _, t in rows if a == k)) for k in (None, "hot")
    ]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in text and "REPARTITION_BY_NUM" in text
    # read from below: pieces, the sum over their sizes, the check, the join of the pieces
    assert text.index("listagg(__piece") < text.index("raise_error") < text.index("listagg(__item")
    dealt = df.repartitionByRange(12, "k", "o").select("k", F.spark_partition_id().alias("p")).distinct()
    assert dealt.where("k = 'hot'").count() >= 3


def test_items_are_those_of_the_lists(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "k string, o int, t string")
    got = list_items(df, ["k"], F.col("t"), [F.col("o")], "t")
    assert got.columns == ["k", "order_0", "t"]
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in df.where("t is not null").toDF("k", "order_0", "t").collect())
