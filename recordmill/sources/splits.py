"""Text files read by their splits: a digest of the content, and rows that run over lines.

A file is read as lines, each by the task whose split it starts in. What a split needs to know about the ones before it
(where its first line stands, whether that line is inside quotes) is a prefix over one small row per split; that table
is broadcast, and the splits are then worked on in parallel, each from its own place.

The rows a broadcast holds are splits of one read, which ``ingest`` bounds by files and by bytes.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.session import shared_dir

LEAF = 1 << 20  # bytes of a leaf of the hash tree
FAN = 4096  # leaves of a node


def without_scheme(path: Column) -> Column:
    # the usual form needs no pattern, which counts where a path goes with every row
    usual = F.startswith(path, F.lit("file:///")) & ~F.startswith(path, F.lit("file:////"))
    other = F.when(F.startswith(path, F.lit("file:/")), F.regexp_replace(path, r"^file:/+", "/")).otherwise(path)
    return F.when(usual, F.substring(path, len("file:///"), 1 << 30)).otherwise(other)


def plain_path(encoded: Column) -> Column:
    """File path as stored: metadata columns are percent-encoded, a plus sign is itself."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    coded = F.contains(encoded, F.lit("%"))
    return F.when(coded, without_scheme(decoded)).otherwise(without_scheme(encoded))


def lines_of(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file_path, block (first byte of the split) and value of all lines; a carriage return stays in its line."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """A cut of the lineage in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of every run of equal keys."""
    edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    return ((a, b) for a, b in zip(edges, edges[1:]) if b > a)


# --- digest of the content ---------------------------------------------------------------------------------------


class _Leaves:
    """Digests of the leaves of one split; a leaf that another split holds a piece of is given as its bytes."""

    def __init__(self, split: int, first: int, last: bool) -> None:
        self.split, self.at, self.last = split, first, last
        self.start, self.held = first, bytearray()

    def _leaf(self, whole: bool) -> tuple:
        row = (self.split, self.start // LEAF, self.start)
        done = whole and self.start % LEAF == 0
        out = (*row, hashlib.sha256(self.held).hexdigest(), None) if done else (*row, None, bytes(self.held))
        self.start, self.held = self.at, bytearray()
        return out

    def add(self, data: bytes | memoryview) -> Iterator[tuple]:
        view = memoryview(data)
        while len(view):
            room = LEAF - self.at % LEAF
            self.held += view[:room]
            self.at += len(view[:room])
            view = view[room:]
            if self.at % LEAF == 0:
                yield self._leaf(True)

    def end(self) -> Iterator[tuple]:
        if self.held:
            yield self._leaf(self.last)


_LEAF_ROWS = pa.schema(
    [("split", pa.int64()), ("leaf", pa.int64()), ("at", pa.int64()), ("digest", pa.string()), ("piece", pa.binary())]
)


def _joined(lines: pa.Array) -> bytes | memoryview:
    """The lines with a line end behind each."""
    if lines.type != pa.binary() or lines.nbytes > 1 << 30:  # beyond the offsets of one joined value
        return b"\n".join(lines.to_pylist()) + b"\n"
    whole = pa.concat_arrays([lines, pa.array([b""], pa.binary())])
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), b"\n")
    return memoryview(text[0].as_buffer())


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (split, first, last, value), the lines of a split one after another, to leaves.

    The first line of a file comes along as a piece of leaf -1.
    """

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _LEAF_ROWS.types)], schema=_LEAF_ROWS)

    now: _Leaves | None = None
    for batch in batches:
        if batch.column("first").null_count:
            raise RuntimeError("the splits of a file changed between two reads of it")
        found: list[tuple] = []
        for a, b in _runs(batch.column("split").to_numpy()):
            split = batch.column("split")[a].as_py()
            if now is None or now.split != split:
                found += now.end() if now else ()
                now = _Leaves(split, batch.column("first")[a].as_py(), batch.column("last")[a].as_py())
                if now.at == 0:
                    found.append((split, -1, 0, None, batch.column("value")[a].as_py()))
            found += now.add(_joined(batch.column("value").slice(a, b - a)))
        if found:
            yield out(found)
    if now and (rest := list(now.end())):
        yield out(rest)


def digests(spark: SparkSession, paths: str | Sequence[str], splits: DataFrame) -> DataFrame:
    """(file_path, tree, line): the SHA-256 hash tree of every file, whatever its size and its splits, and its first line.

    Leaves are the file's bytes in blocks of ``LEAF``, nodes ``FAN`` leaves: a node is the SHA-256 of its leaves' hex
    digests in order, ``tree`` that of its nodes' digests. A line end is counted behind the last line, be it there or
    not. ``splits`` has file_path, block and n_bytes (line ends included) of each split, stored. Only the first and
    last block of a split, where another split holds the rest, move as bytes; the others as digests.
    """
    in_file = Window.partitionBy("file_path").orderBy("block")
    before = F.coalesce(F.sum("n_bytes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lead("block").over(in_file).isNull()
    placed = splits.select("file_path", "block", before.alias("first"), last.alias("last"))
    placed = written(placed.withColumn("split", F.monotonically_increasing_id()), "splits")
    lines = lines_of(spark, paths).join(F.broadcast(placed), ["file_path", "block"], "left")
    rows = lines.select("split", "first", "last", F.col("value").cast("binary").alias("value"))
    found = rows.mapInArrow(_leaves, "split long, leaf long, at long, digest string, piece binary")
    pieces = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("at", "piece"))))
    joined = F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    first_line = F.max(F.when(F.col("leaf") < 0, F.col("piece").cast("string")))
    leaf = found.join(placed.select("split", "file_path"), "split").groupBy("file_path", "leaf").agg(
        F.coalesce(F.max("digest"), F.sha2(joined, 256)).alias("digest"), first_line.alias("line")
    )
    leaf = leaf.withColumn("digest", F.when(F.col("leaf") >= 0, F.col("digest")))
    node = leaf.groupBy("file_path", F.floor(F.col("leaf") / FAN).alias("node")).agg(
        F.sha2(F.expr("listagg(digest) within group (order by leaf)").cast("binary"), 256).alias("digest"),
        F.max("line").alias("line"),
    )
    return node.groupBy("file_path").agg(
        F.sha2(F.expr("listagg(digest) within group (order by node)").cast("binary"), 256).alias("tree"),
        F.max("line").alias("line"),
    )


def tree_of(data: bytes) -> str:
    """The same tree of bytes at hand."""
    if data and not data.endswith(b"\n"):
        data += b"\n"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    leaves = [sha(data[i : i + LEAF]) for i in range(0, len(data), LEAF)]
    return sha("".join(sha("".join(leaves[i : i + FAN]).encode()) for i in range(0, len(leaves), FAN)).encode())


# --- rows over several lines -------------------------------------------------------------------------------------

_BODY = re.compile(rb'(?>(?:[^"]+|"")*)')  # what can stand inside quotes


@lru_cache
def _opens(separator: bytes) -> re.Pattern[bytes]:
    """A line, from the start of a field, whose last field opens a quote and does not close it."""
    s = re.escape(separator)
    field = rb'(?:"%b"[^%b]*|[^"%b][^%b]*)?' % (_BODY.pattern, s, s, s)
    return re.compile(rb'(?>(?:%b%b)*)"%b\Z' % (field, s, _BODY.pattern))


def inside_after(line: bytes, inside: bool, separator: bytes) -> bool:
    """Whether the end of a line is inside quotes, given that for its start.

    A quote opens at the start of a field only. One that is not doubled closes, and what follows it up to the
    delimiter belongs to the field.
    """
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        at = _BODY.match(line).end()
        if at == len(line):
            return True
        at = line.find(separator, at) + 1
        if not at:
            return False
    return _opens(separator).match(line, at) is not None


def _effects(separator: bytes):
    """Rows (file, block, value) to one row per split: whether its end is inside quotes, for either start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, out, kept = None, False, True
        rows: list[tuple] = []
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            for file, block, line in zip(files, blocks, batch.column("value").to_pylist()):
                if key != (file, block):
                    if key:
                        rows.append((*key, out, kept))
                    key, out, kept = (file, block), False, True
                if b'"' in line:
                    out, kept = inside_after(line, out, separator), inside_after(line, kept, separator)
        if key:
            rows.append((*key, out, kept))
        if rows:
            types = [pa.int32(), pa.int64(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "from_outside", "from_inside"])

    return run


def states(effects: DataFrame) -> DataFrame:
    """(file, block, inside): the state in which each split of a file starts.

    A split maps the state at its start to that at its end: it sets it, keeps it or turns it. What it starts with is
    the last value set before it, turned by the splits in between; the first split starts outside.
    """
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("from_outside") == F.col("from_inside")
    turns = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    turned = effects.withColumn("turned", F.coalesce(F.sum(turns).over(in_file), F.lit(0)))
    known = F.when(sets, F.struct(F.col("from_outside").cast("int").alias("value"), "turned"))
    last = F.last(known, ignorenulls=True).over(in_file)
    value = F.coalesce(last["value"] + F.col("turned") - last["turned"], F.col("turned"))
    return turned.select("file", "block", (value % 2 == 1).alias("inside"))


# What a task makes of its split: a row, the rest of a row that began before, or the start of one that goes on.
_WHOLE, _REST, _START = 0, 1, 2


def _rows(separator: bytes):
    """Rows (file, block, inside, value) to (file, block, kind, header, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, rest, header = None, False, False, False
        held: list[bytes] = []
        for batch in batches:
            if batch.column("inside").null_count:
                raise RuntimeError("the splits of a file changed between two reads of it")
            rows: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("file", "block", "inside", "value")]
            for file, block, starts, line in zip(*columns):
                if key != (file, block):
                    if held:
                        rows.append((*key, _REST if rest else _START, header, b"\n".join(held)))
                    key, inside, rest, header, held = (file, block), starts, starts, block == 0, []
                held.append(line)
                inside = inside_after(line, inside, separator)
                if inside:
                    continue
                text = b"\n".join(held)
                held = []
                if rest:
                    rows.append((*key, _REST, False, text))
                    rest = False
                elif text.strip():
                    if not header:
                        rows.append((*key, _WHOLE, False, text))
                    header = False
            if rows:
                yield out(rows)
        if held:
            yield out([(*key, _REST if rest else _START, header, b"\n".join(held))])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, ["file", "block", "kind", "header", "text"])

    return run


def quoted_rows(spark: SparkSession, paths: Sequence[str], separator: str, read: Sequence[str] | None = None) -> DataFrame:
    """(source_file, text): the rows of delimited files whose quoted fields may hold line breaks, without headers.

    Rows are cut at line ends outside quotes, by all tasks at once: a first pass finds what each split does to the
    state of quoting, a prefix gives the state it starts in, a second pass cuts its rows. Pieces of rows that run
    over split borders, two per split at most, are joined afterwards. Blank lines are no rows. ``paths`` are the
    files' names, ``read`` the same as the reader takes them, with its wildcards escaped.
    """
    mark = separator.encode()
    files = F.broadcast(spark.createDataFrame(list(enumerate(paths)), "file int, file_path string"))
    lines = lines_of(spark, list(read or paths)).join(files, "file_path")
    lines = lines.select("file", "block", F.col("value").cast("binary").alias("value"))
    effects = lines.mapInArrow(_effects(mark), "file int, block long, from_outside boolean, from_inside boolean")
    placed = lines.join(F.broadcast(states(effects)), ["file", "block"], "left").select("file", "block", "inside", "value")
    cut = written(placed.mapInArrow(_rows(mark), "file int, block long, kind int, header boolean, text binary"), "rows")
    in_file = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    broken = cut.where(F.col("kind") != _WHOLE).withColumn("number", F.sum((F.col("kind") == _START).cast("int")).over(in_file))
    joined = broken.groupBy("file", "number").agg(
        F.expr(r"listagg(cast(text as string), '\n') within group (order by block)").alias("text"), F.bool_or("header").alias("header")
    )
    whole = cut.where(F.col("kind") == _WHOLE).select("file", F.col("text").cast("string").alias("text"))
    rows = whole.unionByName(joined.where(~F.col("header")).select("file", "text"))
    return rows.join(files, "file").select(F.col("file_path").alias("source_file"), F.regexp_replace("text", r"\r\z", "").alias("text"))
