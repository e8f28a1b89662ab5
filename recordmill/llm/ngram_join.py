"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with equal shingles are one class from the start. Classes that share a band of MinHash values meet in a bucket;
there, MinHash values are compared a few at a time, and a pair is dropped as soon as the posterior probability that
its similarity reaches the threshold falls below a tolerance. What is left joins classes into provisional groups.
Inside a group all pairs are compared in the same way and the rest is verified on the whole shingle sets. Pairs live
in memory only: tasks hand on the number of links of each class and a spanning forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import let_go, pieces, workspace, written
from recordmill.llm.components import components
from recordmill.llm.shingles import min_hashes, shingle_sets

WIDTH = 5  # words of a shingle
THRESHOLD = 0.8
BANDS, ROWS = 24, 4  # a pair of similarity 0.8 misses all bands with probability 3e-6
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-7
BLOCK = 512  # classes of a bucket or group compared at a time; larger ones are cut into blocks
BLOCK_SHINGLES = 1 << 20

HASHES = BANDS * ROWS


def least_matches(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(compared, least matches to go on) at each stop.

    With a flat prior, after k matches of n the similarity has a Beta(k + 1, n - k + 1) posterior, and
    P(similarity >= t) equals P(Binomial(n + 1, t) <= k).
    """
    out = []
    for n in range(step, hashes + 1, step):
        total, k = 0.0, -1
        while total < tolerance:
            k += 1
            total += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
        out.append((n, k))
    return out


def pruned(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, stops: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i of ``left``, j of ``right``) that no stop drops."""
    matches = np.zeros(len(i), dtype=np.int32)
    before = 0
    for n, k in stops:
        matches += (left[i, before:n] == right[j, before:n]).sum(1)
        go = matches >= k
        i, j, matches, before = i[go], j[go], matches[go], n
    return i, j


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of one key each, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            own = tuple(key[a])
            if held and own != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            held_key = own
    if held:
        yield pa.Table.from_batches(held)


def _pairs(side: np.ndarray, one_block: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block with itself, or of the first block (side 0) with the second."""
    n = len(side)
    if one_block:
        return np.triu_indices(n, 1)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return np.repeat(first, len(second)), np.tile(second, len(first))


def class_of(shingles: bytes) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


def described(docs: DataFrame) -> DataFrame:
    """doc_id, ref (a hash of the text if doc_id is null), class (16 bytes, from the whole set; null without words),
    number of shingles, MinHash values, bands."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in pieces(texts):
                sets = shingle_sets(texts[a:b], WIDTH)
                marks = min_hashes(sets, HASHES)
                names = [class_of(s.tobytes()) if len(s) else None for s in sets]
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("ref"), pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([m.tobytes() for m in marks], pa.binary()),
                     pa.array(list(marks.view(np.int64)), pa.list_(pa.int64()))],
                    ["doc_id", "ref", "class", "n", "marks", "bands"],
                )

    ref = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("ref")
    schema = "doc_id long, ref long, class binary, n long, marks binary, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").select("doc_id", "text", ref).mapInArrow(each, schema)


def _blocked(members: DataFrame, key: str) -> DataFrame:
    """Members (key, class, n, all, size) to pairs of blocks: (key, x, y, side, class); most keys have one block.

    A class goes to a block by its own bits; it meets the members of all blocks, its own included, once.
    """
    blocks = F.greatest(F.ceil(F.col("all") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    each = own.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return each.select(
        key, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "class",
    )


def provisional(classes: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Edges (a, b) between classes that share a band and pass all stops; a spanning forest of each bucket."""
    stops = least_matches(threshold, tolerance)
    banded = classes.select("class", "n", F.posexplode("bands").alias("band", "value"))
    banded = banded.select("class", "n", F.xxhash64("band", "value").alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("all"), F.sum("n").alias("size")).where(F.col("all") > 1)
    met = _blocked(banded.join(crowded, "bucket").withColumn("size", F.lit(0)), "bucket").join(classes.select("class", "marks"), "class")
    met = met.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for group in _whole_groups(batches, ["bucket", "x", "y"]):
            names = group.column("class").to_pylist()
            marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint16).reshape(-1, HASHES)
            side = group.column("side").to_numpy()
            i, j = _pairs(side, group.column("x")[0] == group.column("y")[0])
            i, j = pruned(marks, marks, i, j, stops)
            forest = _Forest(len(names))
            for a, b in zip(i.tolist(), j.tolist()):
                if forest.join(a, b):
                    out_a.append(names[a])
                    out_b.append(names[b])
            if len(out_a) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])
                out_a, out_b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])

    return met.mapInArrow(each, "a binary, b binary")


def _similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, on whole sets. Many pairs are counted by products of 0/1 matrices."""
    size = np.array([len(s) for s in sets])
    if len(i) > 4 * len(sets):
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for low in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            part = np.zeros((len(sets), 4096), dtype=np.float32)
            part[row[a:b], column[a:b] - low] = 1
            common += part @ part.T
        both = common[i, j].astype(np.int64)
    else:
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], dtype=np.int64)
    return both >= threshold * (size[i] + size[j] - both) - 1e-9


def with_sets(texts: DataFrame) -> DataFrame:
    """One row per class (class, rows, marks, shingles) from rows (class, rows, marks, text), those whose text has
    the class; others only share its doc_id."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in pieces(texts):
                rows = batch.slice(a, b - a)
                sets = [s.tobytes() for s in shingle_sets(texts[a:b], WIDTH)]
                own = [class_of(s) == c for s, c in zip(sets, rows.column("class").to_pylist())]
                out = [rows.column(c) for c in ("class", "rows", "marks")] + [pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, ["class", "rows", "marks", "shingles"]).filter(pa.array(own, pa.bool_()))

    some = texts.select("class", "rows", "marks", "text").mapInArrow(each, "class binary, rows long, marks binary, shingles binary")
    return some.groupBy("class").agg(*[F.any_value(c).alias(c) for c in ("rows", "marks", "shingles")])


def verified(members: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Members of blocks (root, root_bits, x, y, side, class, rows, marks, shingles) to links: (class, other, linked).

    ``linked`` is the number of rows linked to ``class`` in this pair of blocks; rows with ``other`` are edges of a
    spanning forest and count nothing.
    """
    stops = least_matches(threshold, tolerance)

    def links(own: pa.Table) -> pa.RecordBatch | None:
        names = own.column("class").to_pylist()
        rows = own.column("rows").to_numpy()
        marks = np.frombuffer(b"".join(own.column("marks").to_pylist()), np.uint16).reshape(-1, HASHES)
        i, j = _pairs(own.column("side").to_numpy(), own.column("x")[0] == own.column("y")[0])
        i, j = pruned(marks, marks, i, j, stops)
        if not len(i):
            return None
        need = np.unique(np.concatenate([i, j]))
        place = np.zeros(len(names), dtype=np.int64)
        place[need] = np.arange(len(need))
        sets = [np.frombuffer(s, np.uint64) for s in own.column("shingles").take(pa.array(need)).to_pylist()]
        good = _similar(sets, place[i], place[j], threshold)
        i, j = i[good], j[good]
        linked = np.bincount(i, rows[j], len(names)) + np.bincount(j, rows[i], len(names))
        forest = _Forest(len(names))
        tree = [(a, b) for a, b in zip(i.tolist(), j.tolist()) if forest.join(a, b)]
        at = np.flatnonzero(linked)
        return pa.RecordBatch.from_arrays(
            [pa.array([names[a] for a in at] + [names[a] for a, _ in tree], pa.binary()),
             pa.array([None] * len(at) + [names[b] for _, b in tree], pa.binary()),
             pa.array([int(linked[a]) for a in at] + [0] * len(tree), pa.int64())],
            ["class", "other", "linked"],
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches, ["root_bits", "x", "y"]):
            roots = group.column("root").to_pylist()
            for root in dict.fromkeys(roots):
                own = group.filter(pa.array([r == root for r in roots]))
                if (out := links(own)) is not None:
                    yield out

    return members.mapInArrow(each, "class binary, other binary, linked long")


def joined(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read): doc_id, class_id, n_links, n_copies.

    Two rows are linked if the Jaccard similarity of their shingles is at least ``threshold``; class_id is the
    smallest doc_id that can be reached by links, n_links the number of rows linked to the row, n_copies that of
    rows with its very shingles, itself included. A row without words (null or empty text) is a class of its own
    and has no links. Repeated rows are copies of each other. Rows with a null doc_id are linked and counted like
    others; class_id is null if no row that can be reached has an id. An empty table gives an empty table.
    """
    folder = workspace(docs.sparkSession, "ngram-join")
    every = written(described(docs), folder, "described")
    classes = (
        every.where("class is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first"), F.min("ref").alias("ref"), F.count(F.lit(1)).alias("rows"), F.any_value("n").alias("n"),
             F.any_value("marks").alias("marks"), F.any_value("bands").alias("bands"))
    )
    classes = written(classes, folder, "classes")
    groups = written(components(provisional(classes, threshold, tolerance), f"{folder}/groups"), folder, "group-of")
    sizes = groups.join(classes.select(F.col("class").alias("node"), "n"), "node").groupBy("root").agg(
        F.count(F.lit(1)).alias("all"), F.sum("n").alias("size")
    )
    blocked = _blocked(groups.withColumnRenamed("node", "class").join(sizes, "root"), "root")
    held = groups.select(F.col("node").alias("class")).join(classes.select("class", "first", "ref", "rows", "marks"), "class")
    ids = docs.select(F.col("doc_id").cast("long"), "text")
    texts = ids.join(held.drop("ref").withColumnRenamed("first", "doc_id"), "doc_id").drop("doc_id")
    # classes without any id find their texts by hash
    bare = ids.where("doc_id is null").select("text").distinct().withColumn("ref", F.xxhash64("text"))
    texts = texts.unionByName(bare.join(held.where("first is null").drop("first"), "ref").drop("ref"))
    members = blocked.join(with_sets(texts), "class").withColumn("root_bits", F.xxhash64("root"))
    members = members.repartition("root_bits", "x", "y").sortWithinPartitions("root_bits", "x", "y", "root")
    links = written(verified(members, threshold, tolerance), folder, "links")
    linked = links.groupBy("class").agg(F.sum("linked").alias("linked"))
    roots = components(links.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")), f"{folder}/classes-of")
    named = classes.select("class", "first", "rows").join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    lowest = named.groupBy("root").agg(F.min("first").alias("class_id"))
    named = named.join(lowest, "root").join(linked, "class", "left").select(
        "class", "class_id", "rows", (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links")
    )
    out = every.select("doc_id", "class").join(named, "class", "left")
    return out.select(
        "doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("rows", F.lit(1)).alias("n_copies"),
    )
