"""Benchmark decontamination with DataFrame functions only.

A window is as many consecutive words of a text as a benchmark item has. Windows that can reach the threshold get a
SimHash fingerprint of their words; fingerprints are cut into ``RADIUS + 1`` blocks, so that any two within the
radius agree in a block (pigeonhole). A block has three or four bits, too few to meet on alone: windows and items of one
size meet on equal blocks if they also share one of their rarest shingles, which any pair at the threshold does. Pairs
within the radius are then compared exactly: weighted Jaccard similarity of their shingles, a shingle weighing as often
as it occurs.

Which windows can reach the threshold follows from their shingles: of m shingles at most m - o are not the item's,
where o is the least overlap, so one of the first m - o + 1 and one of the last m - o + 1 is. A bit table of the
items' shingles, of bounded size, finds the texts where this can be so; the exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import words, workspace, written

WIDTH = 5
THRESHOLD = 0.8
RADIUS = 20  # of 64 bits; a window at the threshold is farther with a probability of about 3e-5
TABLE_BITS = (20, 24)  # least and most size of the bit table, as powers of two; 2 MiB at most


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``radius + 1`` blocks of nearly equal size."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block(mark: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(mark, first).bitwiseAND(F.lit((1 << bits) - 1))


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row; a plain column would be computed anew in every call of
    a lambda function that mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def _numbers(ws: Column) -> Column:
    return F.transform(ws, lambda x: F.xxhash64(x))


def _shingle_numbers(numbers: Column, n: Column, width: int) -> Column:
    """One number per shingle of the words' numbers; null where there are fewer words than ``width``."""
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(F.slice(numbers, i, width))))


def fingerprint(ws: Column) -> Column:
    """64-bit SimHash of words: a bit is set if most words' hashes have it."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def bits(numbers: Column) -> Column:
        def bit(b: Column) -> Column:
            count = F.aggregate(numbers, zero, lambda a, h: a + F.call_function("shiftrightunsigned", h, b).bitwiseAND(one))
            return F.when(count * 2 > F.size(numbers), F.call_function("shiftleft", one, b)).otherwise(zero)

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), zero, lambda a, x: a.bitwiseOR(x))

    return _with(_numbers(ws), bits)


def bag(ws: Column, width: Column) -> Column:
    """Shingles as text, each with the number of its occurrence, so that equal ones count as often as they come."""

    def numbered(each: Column) -> Column:
        def occurrence(s: Column, i: Column) -> Column:
            return F.concat_ws(" #", s, (F.size(F.filter(F.slice(each, 1, i), lambda t: t == s)) + 1).cast("string"))

        single = F.transform(each, lambda s: F.concat_ws(" #", s, F.lit("1")))
        return F.when(F.size(F.array_distinct(each)) == F.size(each), single).otherwise(F.transform(each, occurrence))

    return _with(F.transform(F.sequence(F.lit(1), F.size(ws) - width + 1), lambda i: F.array_join(F.slice(ws, i, width), " ")), numbered)


def prepared(benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Items with at least a word: item_id, words, n, width (fewer than ``WIDTH`` words are one shingle), shingles m and
    the number ``spare`` of a window's shingles that may be missing."""
    items = benchmark.select("item_id", words("text").alias("ws")).select("*", F.size("ws").alias("n")).where("n > 0")
    items = items.withColumn("width", F.least("n", F.lit(WIDTH))).withColumn("m", F.col("n") - F.col("width") + 1)
    least = F.ceil(F.col("m") * (2 * threshold / (1 + threshold)) - 1e-9)
    return items.withColumn("spare", (F.col("m") - least).cast("int"))


def _slots(number: Column, bits: int) -> list[Column]:
    """Two places of a number in the bit table; a number is known only if both are set."""
    return [F.pmod(number, F.lit(bits)), F.pmod(F.xxhash64(number), F.lit(bits))]


def _bit_table(shingles: DataFrame) -> tuple[DataFrame, int]:
    """A one-row table with the bits of the shingles' numbers as longs, and the number of bits."""
    n = shingles.count()
    power = min(max(TABLE_BITS[0], (64 * n).bit_length()), TABLE_BITS[1])
    size = 1 << (power - 6)
    slot = F.col("slot")
    placed = shingles.select(F.explode(F.array(*_slots(F.col("number"), 1 << power))).alias("slot"))
    set_ = placed.groupBy(F.shiftright(slot, 6).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("v")
    )
    every = shingles.sparkSession.range(size).join(set_, "id", "left").select(F.struct("id", F.coalesce("v", F.lit(0)).alias("v")).alias("x"))
    return every.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["v"]).alias("bits")), 1 << power


def _text_key(ws: Column) -> Column:
    return F.md5(F.array_join(ws, " "))


def _sharing(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(n, window_key, own) of windows and items of one size that can reach the threshold.

    Shingles are put in one order for all, by the number of items that have them; those of no item come first. Two sets
    of m shingles that share at least m - spare agree in one of the first spare + 1 of each. So a shingle that many
    items hold makes candidates only where the rarer ones leave no other choice.
    """
    token = F.explode(F.transform("bag", lambda t: F.xxhash64(t))).alias("token")
    often = items.select("n", "spare", token).groupBy("n", "spare", "token").agg(F.count("*").alias("often"))

    def firsts(sets: DataFrame, name: str) -> DataFrame:
        known = sets.select("n", name, F.size("bag").alias("m"), token).join(often, ["n", "token"])
        known = known.groupBy("n", name, "m", "spare").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("known"))
        of_items = F.col("spare") + 1 - (F.col("m") - F.size("known"))
        known = known.where(of_items > 0).select("n", name, F.explode(F.slice("known", F.lit(1), of_items)).alias("x"))
        return known.select("n", name, "x.token")

    return firsts(windows, "window_key").join(firsts(items, "own"), ["n", "token"]).select("n", "window_key", "own").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """Texts and the items they hold: (key, item_id, start, similarity), where key is the MD5 of the text."""
    folder = workspace(docs.sparkSession, "decontaminate")
    items = written(
        prepared(benchmark, threshold).withColumns(
            {"mark": fingerprint(F.col("ws")), "bag": bag(F.col("ws"), F.col("width")), "own": _text_key(F.col("ws"))}
        ),
        folder,
        "items",
    )
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # at most WIDTH rows
    parts = [
        items.where(F.col("width") == w)
        .select("n", "width", "m", "spare", F.explode(_shingle_numbers(_numbers(F.col("ws")), F.col("n"), w)).alias("number"))
        for w in widths
    ]
    if not parts:
        none = docs.limit(0).select(F.lit("").alias("key"), F.lit(0).cast("long").alias("item_id"))
        return none.select("*", F.lit(0).alias("start"), F.lit(0.0).alias("similarity"))
    known = parts[0]
    for p in parts[1:]:
        known = known.unionByName(p)
    known = written(known.distinct(), folder, "shingles")
    table, bits = _bit_table(known.select("width", "number").distinct())

    # texts with a shingle that may be an item's, each text once
    text = docs.where("text is not null").select(F.md5(F.col("text").cast("binary")).alias("key"), words("text").alias("ws"))
    text = text.select("key", "ws", F.size("ws").alias("n_words"), table.scalar().alias("bits"))

    def may(number: Column) -> Column:
        def is_set(slot: Column) -> Column:
            word = F.get(F.col("bits"), F.shiftright(slot, 6).cast("int"))
            return F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

        one, other = _slots(number, bits)
        return is_set(one) & is_set(other)

    def hits(numbers: Column) -> Column:
        def of(width: int) -> Column:
            every = F.coalesce(_shingle_numbers(numbers, F.col("n_words"), width), F.array().cast("array<bigint>"))
            placed = F.transform(every, lambda h, i: F.struct(F.lit(width).alias("width"), i.alias("at"), h.alias("number")))
            return F.filter(placed, lambda x: may(x["number"]))

        return F.concat(*map(of, widths))

    held = text.select("key", "ws", "n_words", _with(_numbers(F.col("ws")), hits).alias("hits")).where(F.size("hits") > 0)
    held = written(held.dropDuplicates(["key"]), folder, "held")

    spots = held.select("key", "n_words", F.explode("hits").alias("h")).select("key", "n_words", "h.*").join(known, ["width", "number"])
    spots = spots.groupBy("key", "n_words", "n", "width", "m", "spare").agg(F.collect_set("at").alias("at"))
    m, spare = F.col("m"), F.col("spare")
    near_start = F.flatten(F.transform("at", lambda p: F.sequence(p - spare, p)))
    near_end = F.flatten(F.transform("at", lambda p: F.sequence(p - m + 1, p - m + 1 + spare)))
    starts = F.filter(F.array_intersect(near_start, near_end), lambda s: (s >= 0) & (s <= F.col("n_words") - F.col("n")))
    windows = spots.select("key", "n", "width", F.explode(starts).alias("start")).join(held.select("key", "ws"), "key")
    windows = windows.select("key", "n", "width", "start", F.slice("ws", F.col("start") + 1, F.col("n")).alias("window"))
    windows = written(windows.withColumn("window_key", _text_key(F.col("window"))), folder, "windows")
    # equal windows of any texts once, equal items once
    single = windows.select("n", "width", "window", "window_key").distinct()
    single = single.select("n", "window_key", fingerprint(F.col("window")).alias("mark"), bag(F.col("window"), F.col("width")).alias("bag"))
    single = written(single, folder, "fingerprints")
    own = items.select("n", "spare", "own", "mark", "bag").distinct()

    # windows and items meet where their fingerprints agree in a block, and only those that share a rare shingle
    candidates = _sharing(single, own).join(single.select("window_key", "mark"), "window_key")
    blocks = _blocks(radius)

    def blocked(df: DataFrame, mark: str) -> DataFrame:
        each = F.array(*[F.struct(F.lit(i).alias("block"), _block(F.col(mark), a, b).alias("value")) for i, (a, b) in enumerate(blocks)])
        return df.select("*", F.explode(each).alias("x")).select(*df.columns, "x.block", "x.value")

    right = blocked(own.select("own", F.col("mark").alias("item_mark")), "item_mark")
    difference = F.col("mark").bitwiseXOR(F.col("item_mark"))
    first = F.array_position(F.array(*[_block(difference, a, b) for a, b in blocks]), F.lit(0).cast("long"))
    pairs = blocked(candidates, "mark").join(right, ["own", "block", "value"])
    pairs = pairs.where((F.bit_count(difference) <= radius) & (first == F.col("block") + 1)).select("window_key", "own")

    # whole bags of the pairs that are left
    bags = pairs.join(single.select("window_key", "bag"), "window_key").join(own.select("own", F.col("bag").alias("item_bag")), "own")
    common = F.size(F.array_intersect("bag", "item_bag"))
    similarity = common / (F.size("bag") + F.size("item_bag") - common)
    found = bags.select("window_key", "own", similarity.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)
    found = found.join(items.select("own", "item_id"), "own")
    return windows.join(found, "window_key").select("key", "item_id", "start", "similarity")


def judged(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read): doc_id, contaminated, n_items, items
    (sorted ids), similarity (the best, 0 if none).

    ``benchmark`` needs item_id and text. Null and empty texts hold nothing, and such items match nothing; repeated
    rows are judged alike; an empty table gives an empty table, an empty benchmark no contamination.
    """
    found = matches(docs, benchmark, threshold, radius)
    per_text = found.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity"))
    own = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key")).join(per_text, "key", "left")
    none = F.array().cast("array<bigint>")
    return own.select(
        "doc_id", F.col("similarity").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    found = matches(docs, benchmark, threshold, radius).select(F.col("key").alias("_held")).distinct()
    return docs.join(found, F.md5(docs["text"].cast("binary")) == found["_held"], "left_anti")
