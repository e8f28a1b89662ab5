"""How filters interact: what each order of five filters removes at each step, per part of the corpus.

Documents become cells: a bit per filter that fails, counted per part. A part's counts are a 2x2x2x2x2 tensor, and
every figure of every step is a contraction of it, with a selector of passing, failing or all documents on each axis.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.common import workspace, written
from recordmill.llm.pieces import pieces

FILTERS = "ABCDE"

# Parameters of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS) + b"]")

SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_fails(text: str) -> int:
    """Bits 0 to 3: the conditions A to D on which a text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    n, distinct = 0, set()
    for piece in pieces(raw, _BLANK):
        found = piece.split()
        n += len(found)
        distinct.update(found)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (n < MIN_WORDS)
        | (100 * len(distinct) < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * len(text)) << 2
        | (_SYMBOL.search(raw) is not None) << 3
    )


def described(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails (bits of A to D) and the digest of the text of every row; texts go no further."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                fails.append(text_fails(text))
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
            columns = [batch.column(0), batch.column(1), pa.array(fails, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "fails", "digest"])

    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").cast("long"), part, "text")
    return rows.mapInArrow(describe, "doc_id long, part string, fails int, digest binary")


def cells(rows: DataFrame) -> DataFrame:
    """part, cell (bits of A to E) and its counts n, good and toxic.

    Of the rows of one digest those with the smallest id pass filter E. A map task sends one of them per digest
    before anything is shuffled, whatever the size of a group of copies.
    """
    # a null id is neither smaller nor greater than another
    known, nameless = rows.where("doc_id is not null"), rows.where("doc_id is null")
    by_id = Window.partitionBy("digest").orderBy("doc_id")
    first = known.withColumn("rank", F.rank().over(by_id)).where("rank = 1").drop("rank").unionByName(nameless)
    last_bit = 1 << len(FILTERS) - 1
    keys = ["part", "fails", "good", "toxic"]
    every, passing = (df.groupBy(*keys).count() for df in (rows, first))
    moved = F.expr(f"explode(array(struct(fails as cell, count as n), struct(fails + {last_bit} as cell, -count as n)))")
    counts = every.select("part", (F.col("fails") + last_bit).alias("cell"), F.col("count").alias("n"), "good", "toxic").unionByName(
        passing.select("part", "good", "toxic", moved.alias("m")).select("part", "m.cell", "m.n", "good", "toxic")
    )
    return counts.groupBy("part", "cell").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def selectors() -> dict[str, np.ndarray]:
    """For every order and step: which of (pass, fail) is selected on each of the five axes, as (steps, 5, 2)."""
    n = len(FILTERS)
    every, passing, failing = (1, 1), (1, 0), (0, 1)
    out: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order in permutations(range(n)):
        for step, own in enumerate(order):
            before = set(order[:step])
            out["kept"].append([passing if i in before or i == own else every for i in range(n)])
            out["removed"].append([failing if i == own else passing if i in before else every for i in range(n)])
            out["failing"].append([failing if i == own else every for i in range(n)])
            out["unique_fails"].append([failing if i == own else passing for i in range(n)])
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The tensor (filters' axes E to A, each pass or fail) under every row of selectors."""
    a, b, c, d, e = (chosen[:, i] for i in range(len(FILTERS)))
    return np.einsum("vwxyz,sv,sw,sx,sy,sz->s", tensor, e, d, c, b, a, optimize=True)


def part_rows(part: str, counts: np.ndarray) -> pd.DataFrame:
    """All steps of one part; ``counts`` has n, good and toxic of its 32 cells."""
    n, good, toxic = (counts[i].reshape((2,) * len(FILTERS)) for i in range(3))
    chosen = selectors()
    orders = list(permutations(range(len(FILTERS))))
    own = np.array([i for order in orders for i in order])
    removed = contracted(n, chosen["removed"])
    shapley = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(shapley, own, removed)
    return pd.DataFrame(
        {
            "part": part,
            "filter_order": ["".join(FILTERS[i] for i in order) for order in orders for _ in order],
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders)),
            "kept": contracted(n, chosen["kept"]),
            "removed": removed,
            "redundant": contracted(n, chosen["failing"]) - removed,
            "unique_fails": contracted(n, chosen["unique_fails"]),
            "good_lost": contracted(good, chosen["removed"]),
            "toxic_lost": contracted(toxic, chosen["removed"]),
            "shapley": shapley[own],
        }
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, zeros included, with the columns of ``SCHEMA``.

    ``docs`` needs doc_id, lang and text, ``labels`` doc_id, quality and toxic; other columns are not read. A null text
    is the empty one, a null lang the part of the empty name. Rows that repeat an id with an equal text are equals:
    neither is the copy of the other. A row without an id is no copy and has no label. An id with several labels
    counts as good (toxic) if one of them is 1. No documents give no rows; very long texts are read in pieces.
    """
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    known = known.where("good = 1 or toxic = 1").withColumn("spread", F.lit(0).cast("long"))
    # rows without an id join nothing; they are dealt out by their place
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))
    rows = described(docs).withColumn("spread", spread).join(known, ["doc_id", "spread"], "left").drop("spread")
    rows = rows.fillna(0, ["good", "toxic"])
    rows = written(rows, workspace(docs.sparkSession, "audit"), "rows")
    # at most 32 cells a part
    tensors = cells(rows).groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, found in zip(batch["part"], batch["cells"]):
                counts = np.zeros((3, 1 << len(FILTERS)), dtype=np.int64)
                for cell in found:
                    counts[:, cell["cell"]] = cell["n"], cell["good"], cell["toxic"]
                yield part_rows(part, counts)

    return tensors.mapInPandas(contract, SCHEMA)
