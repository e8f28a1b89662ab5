"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and ``MAX_RATE`` whose expected words meet every source's target, entropy
balancing takes those nearest to 1 in the sense of relative entropy. They have the form
``min(MAX_RATE, exp(dual * size / mean size))`` with one dual number per source, which Newton steps find: every
step is one aggregation over the counted (source, size) cells. Rates are then rounded into whole copies.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.common import WORD, workspace, written

MAX_RATE = 3.0  # no document is taken more often
WEIGHTS = (1.0, 2.0, 3.0)  # of the sources in order, repeating
NEWTON_STEPS = 40
TOLERANCE = 1e-6  # of a target
GROUP_ROWS = 500  # documents rounded together
NULL_KEY = "n"  # source keys are "s" + source, or this one for null; a string key joins without special cases


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the key of the source; size is the number of words, 0 for a null text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), _key("source").alias("skey"))


def _key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit(NULL_KEY)).otherwise(F.concat(F.lit("s"), F.col(source)))


def targets(cells: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per source: its size, documents, words of a mean document and target.

    ``cells`` are counted (skey, source, size, n). The targets share all words by weight; those above ``max_rate``
    times their source stop there and the rest is shared again among the others: with the sources in order of
    capacity over weight, the first that the shared level does not fill ends the stopped ones.
    """
    one = F.lit(1)
    sources = cells.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    # one row per source from here on
    in_order = Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    every = Window.partitionBy(one)
    by_fill = every.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.lit(max_rate) * F.col("source_size")
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = rest / open_weight
    # the first source that its level does not fill: those before it are full, the others share its level
    sources = sources.withColumns({"level": level, "place": F.row_number().over(by_fill)})
    free = F.when(F.col("level") * F.col("weight") <= limit, F.struct("place", "level"))
    sources = sources.withColumn("free", F.min(free).over(every))
    shared = F.col("free.level") * F.col("weight")
    target = F.when(F.col("place") < F.col("free.place"), limit).otherwise(F.coalesce(F.least(limit, shared), limit))
    return sources.select(
        "skey", "source", "source_size", "n_docs", (F.col("source_size") / F.col("n_docs")).alias("mean_size"),
        target.cast("double").alias("target"),
    )


def _rate(dual: Column, size: Column, mean_size: Column, max_rate: float) -> Column:
    """Rate of a document; the exponent stops far beyond the cap, so that it never overflows."""
    return F.least(F.lit(max_rate), F.exp(F.least(F.lit(50.0), dual * size / mean_size)))


def duals(cells: DataFrame, sources: DataFrame, folder: str, max_rate: float = MAX_RATE, steps: int = NEWTON_STEPS) -> DataFrame:
    """``sources`` with their dual numbers.

    The expected words of a source grow with its dual, so every step keeps the interval that holds the solution and
    takes the Newton point if it lies inside, else the middle. A source whose target is its limit needs an infinite
    dual and is full from the start (``dual`` 50 times the scale is beyond the cap for every size).
    """

    def exact(x: Column) -> Column:
        # decimals add up to the same number in any order, so that reruns agree to the last bit
        return F.sum(x.cast("decimal(38,6)")).cast("double")

    full = F.col("target") >= F.lit(max_rate) * F.col("source_size") * (1 - 1e-12)
    state = sources.withColumns(
        {"low": F.lit(-60.0), "high": F.lit(60.0), "dual": F.lit(0.0), "done": full | (F.col("source_size") == 0)}
    )
    state = written(state, folder, "duals-0")
    for step in range(1, steps + 1):
        open_ = state.where(~F.col("done")).select("skey", "dual", "mean_size")
        if open_.isEmpty():
            break
        rate = _rate(F.col("dual"), F.col("size"), F.col("mean_size"), max_rate)
        moment = (
            cells.where("size > 0").join(open_, "skey")
            .select("skey", "n", F.col("size").cast("double").alias("size"), "mean_size", rate.alias("rate"))
            .groupBy("skey")
            .agg(
                exact(F.col("n") * F.col("size") * F.col("rate")).alias("words"),
                exact(
                    F.when(F.col("rate") < max_rate, F.col("n") * F.col("size") * F.col("size") * F.col("rate") / F.col("mean_size"))
                    .otherwise(0.0)
                ).alias("slope"),
            )
        )
        short = F.col("words") < F.col("target")
        low = F.when(short, F.col("dual")).otherwise(F.col("low"))
        high = F.when(short, F.col("high")).otherwise(F.col("dual"))
        newton = F.col("dual") + (F.col("target") - F.col("words")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        close = F.abs(F.col("words") - F.col("target")) <= F.lit(TOLERANCE) * F.col("target")
        nxt = F.when(close, F.col("dual")).when(inside, newton).otherwise((low + high) / 2)
        moved = state.join(moment, "skey", "left")
        known = F.col("words").isNotNull()
        state = written(
            moved.select(
                *[c for c in sources.columns],
                F.when(known, low).otherwise(F.col("low")).alias("low"),
                F.when(known, high).otherwise(F.col("high")).alias("high"),
                F.when(known, nxt).otherwise(F.col("dual")).alias("dual"),
                (F.col("done") | F.coalesce(close, F.lit(False))).alias("done"),
            ),
            folder,
            f"duals-{step}",
        )
    return state.withColumn("full", full)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text; other columns are not read): doc_id, size, source_size,
    target, taken, copies, rate.

    A null text has size 0; a null source is a source of its own, the last one. Documents without words are kept
    once. Repeated rows and equal ids are rounded as any rows. An empty table gives an empty table. Reruns agree:
    rounding depends on the rows alone. Groups of about ``GROUP_ROWS`` documents of one source, cut by a hash, are
    rounded from the longest document to the shortest with the error handed on, so that a group misses its share by
    less than one short document.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "mixture")
    # equal rows are counted, so that one repeated row cannot fill a group
    own = written(sized(docs).groupBy("skey", "source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")), folder, "sizes")
    cells = written(own.groupBy("skey", "source", "size").agg(F.sum("n").alias("n")), folder, "cells")
    sources = duals(cells, written(targets(cells, weights, max_rate), folder, "targets"), folder, max_rate)
    spread = F.pmod(F.xxhash64("doc_id", "size"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / GROUP_ROWS)).cast("long"))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("full"), F.lit(max_rate)).otherwise(
        _rate(F.col("dual"), F.col("size"), F.col("mean_size"), max_rate)
    )
    rated = own.join(sources.drop("source"), "skey").select(
        "skey", spread.alias("spread"), "source_size", "target",
        F.struct((-F.col("size")).alias("order"), "doc_id", "size", "n", rate.alias("rate")).alias("d"),
    )
    start = F.struct(
        F.lit(0.0).alias("error"),
        F.array().cast("array<struct<doc_id:bigint,size:bigint,rate:double,n:bigint,floor:bigint,up:bigint>>").alias("out"),
    )

    def step(acc: Column, d: Column) -> Column:
        floor = F.floor(d["rate"])
        due = acc["error"] + (d["rate"] - floor) * d["size"] * d["n"]
        can = (d["size"] > 0) & (d["rate"] > floor)
        up = F.when(can, F.least(F.greatest(F.round(due / d["size"]), F.lit(0.0)), d["n"])).otherwise(0).cast("long")
        row = F.struct(
            d["doc_id"].alias("doc_id"), d["size"].alias("size"), d["rate"].alias("rate"), d["n"].alias("n"),
            floor.cast("long").alias("floor"), up.alias("up"),
        )
        error = (due - up * d["size"]).cast("double")
        return F.struct(error.alias("error"), F.concat(acc["out"], F.array(row)).alias("out"))

    grouped = rated.groupBy("skey", "spread", "source_size", "target").agg(F.sort_array(F.collect_list("d")).alias("ds"))
    rounded = grouped.select("source_size", "target", F.explode(F.aggregate("ds", start, step, lambda a: a["out"])).alias("d"))
    each = rounded.select("source_size", "target", "d.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("d.n"))).alias("i"))
    copies = F.col("floor") + F.when(F.col("i") <= F.col("up"), 1).otherwise(0)
    return each.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "rate"
    )
