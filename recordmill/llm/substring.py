"""Substring dedup: words covered by a window of words that also starts elsewhere are removed.

The gram of a window with the smallest hash is its anchor; equal windows have equal anchors, and neighbouring windows
share theirs. Windows whose anchor stands in one place only are unique. Of the others, stretches of windows with one
anchor go to that anchor's shard of the reference, equal ones counted once; there a suffix automaton of the shard is
built and the stretches are streamed through it: the states of their matching statistics tell how often a window
occurs. Windows of an anchor with very many places are counted by their digests instead, as their shard has no bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.automaton import SuffixAutomaton
from recordmill.llm.common import workspace, written
from recordmill.llm.shingles import mixed, word_numbers

WINDOW = 35  # consecutive words
GRAM = 8  # words of an anchor
HOT = 4000  # places of an anchor from which its windows are counted by digest
PLACE_BITS = 28  # words of one batch; the rest of 64 bits are the hash that anchors are picked by


def stretches(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one anchor: text, first window, last window (word positions in the text), anchor."""
    numbers, counts = word_numbers(texts)
    none = np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    begin = ends - counts
    windows = np.maximum(counts - WINDOW + 1, 0)
    if not windows.any():
        return none, none, none, none
    gram = numbers.copy()
    for i in range(1, GRAM):
        rest = len(gram) - i
        gram[:rest] = mixed(gram[:rest] * np.uint64(0x9E3779B97F4A7C15) + numbers[i:])
    place = np.uint64(PLACE_BITS)
    least = ((gram >> place) << place) | np.arange(len(gram), dtype=np.uint64)
    width, have = WINDOW - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    anchor = (least[start + begin[text]] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], start[last], gram[anchor[first]].view(np.int64)


def _chunks(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows with their texts, about ``size`` characters at a time; a longer text is whole."""
    texts = batch.column("text").to_pylist()
    a = total = 0
    for b, t in enumerate(texts):
        if b > a and total + len(t) > size:
            yield batch.slice(a, b - a), texts[a:b]
            a, total = b, 0
        total += len(t)
    if texts:
        yield batch.slice(a), texts[a:]


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def anchors(texts: DataFrame) -> DataFrame:
    """The anchors of each text (key, copies, anchor, places), with their places in the text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, some in _chunks(batch):
                text, _, _, anchor = stretches(some)
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                first = np.flatnonzero((np.diff(text, prepend=-1) != 0) | np.concatenate([[True], anchor[1:] != anchor[:-1]])[: len(text)])
                places = np.diff(np.append(first, len(text)))
                at = pa.array(text[first])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key").take(at), rows.column("copies").take(at), pa.array(anchor[first]), pa.array(places)],
                    ["key", "copies", "anchor", "places"],
                )

    return texts.select("key", "copies", "text").mapInArrow(each, "key binary, copies long, anchor long, places long")


def pieces(texts: DataFrame) -> DataFrame:
    """Stretches of repeated anchors from (key, copies, text, cold, hot), where cold and hot list the anchors.

    Rows are (key, copies, hot, shard, digest, starts, words), one for all equal stretches of a text; copies counts
    them in all copies of the text. Of hot anchors, rows are single windows, by their digest alone.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "copies", "hot", "shard", "digest", "starts", "words"]
        kinds = [pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
        for batch in batches:
            for rows, some in _chunks(batch):
                text, first, last, anchor = stretches(some)
                cold, hot = rows.column("cold").to_pylist(), rows.column("hot").to_pylist()
                keys, copies = rows.column("key").to_pylist(), rows.column("copies").to_pylist()
                out: list[tuple] = []
                edge = np.searchsorted(text, np.arange(len(some) + 1))
                for i, t in enumerate(some):
                    words = t.encode("utf-8", "surrogatepass").split()
                    some_cold, some_hot = set(cold[i]), set(hot[i])
                    own: dict[tuple[bool, int, bytes], list[int]] = {}
                    held: dict[bytes, list[bytes]] = {}
                    for j in range(edge[i], edge[i + 1]):
                        a, b, at = int(first[j]), int(last[j]), int(anchor[j])
                        if at in some_cold:
                            digest = _digest(words[a : b + WINDOW])
                            held[digest] = words[a : b + WINDOW]
                            own.setdefault((False, at, digest), []).append(a)
                        elif at in some_hot:
                            for s in range(a, b + 1):
                                own.setdefault((True, at, _digest(words[s : s + WINDOW])), []).append(s)
                    for (is_hot, at, digest), starts in own.items():
                        out.append((keys[i], copies[i] * len(starts), is_hot, at, digest, starts, None if is_hot else b" ".join(held[digest])))
                    if len(out) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return texts.select("key", "copies", "text", "cold", "hot").mapInArrow(
        each, "key binary, copies long, hot boolean, shard long, digest binary, starts array<int>, words binary"
    )


def repeated(shard: list[tuple[bytes, int]]) -> list[list[int]]:
    """For each stretch (words, copies) of a shard, the windows of it that occur more than once in the shard."""
    ids: dict[bytes, int] = {}
    rows = [([ids.setdefault(w, len(ids)) for w in words.split()], copies) for words, copies in shard]
    if len(rows) == 1:  # all windows of one stretch are different, as their anchors would be
        return [list(range(len(rows[0][0]) - WINDOW + 1)) if rows[0][1] > 1 else []]
    automaton = SuffixAutomaton()
    for sequence, copies in rows:
        automaton.add(sequence, copies)
    automaton.settle()
    return [[s for s, n in enumerate(automaton.occurrences(sequence, WINDOW)) if n > 1] for sequence, _ in rows]


def matched(stretch: DataFrame) -> DataFrame:
    """Distinct stretches (shard, digest, words, copies) to the repeated windows of each (shard, digest, windows)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve() -> Iterator[tuple]:
            for row, windows in zip(held, repeated([(w, c) for _, _, w, c in held])):
                if windows:
                    yield row[0], row[1], windows

        out: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "digest", "words", "copies")]):
                if held and held[0][0] != row[0]:
                    out += solve()
                    held = []
                held.append(row)
            if len(out) > 5000:
                yield _found(out)
                out = []
        if held:
            out += solve()
        if out:
            yield _found(out)

    def _found(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shard", "digest", "windows"])

    return stretch.mapInArrow(each, "shard long, digest binary, windows array<int>")


def removed(texts: DataFrame) -> DataFrame:
    """(key, copies, text, marks) to (key, n_words, n_removed, kept_sha256); marks list starts of repeated windows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            marks, copies = batch.column("marks"), batch.column("copies").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                n = len(words)
                if copies[i] > 1 and n >= WINDOW:
                    kept: list[bytes] = []
                elif marks[i].is_valid:
                    starts = np.array(marks[i].as_py(), dtype=np.int64)
                    step = np.bincount(starts, minlength=n + WINDOW + 1) - np.bincount(starts + WINDOW, minlength=n + WINDOW + 1)
                    covered = np.cumsum(step)[:n] > 0
                    kept = [w for w, c in zip(words, covered) if not c]
                else:
                    kept = words
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("key"), *map(pa.array, zip(*out))], ["key", "n_words", "n_removed", "kept_sha256"])

    return texts.select("key", "copies", "text", "marks").mapInArrow(each, "key binary, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read): doc_id, n_words, n_removed, kept_sha256.

    A null text has no words, as an empty one; texts of fewer words than a window keep them all; repeated rows are
    elsewhere to each other, so their windows go in all of them. An empty table gives an empty table. Equal texts are
    handled once, with the number of their rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "substring")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    # texts lie in buckets of their key, so that what is found about them comes to them, not the other way round
    once = keyed.groupBy("key").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once.write.bucketBy(buckets, "key").option("path", f"{folder}/texts").saveAsTable(name)
    texts = spark.table(name)

    places = anchors(texts)
    counted = places.groupBy("anchor").agg(F.sum(F.col("copies") * F.col("places")).alias("copies"), F.sum("places").alias("places")).where("copies > 1")
    counted = counted.select("anchor", (F.col("places") > hot).alias("is_hot"))
    wanted = places.select("key", "anchor").join(counted, "anchor").groupBy("key").agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("anchor"))).alias("cold"), F.collect_set(F.when(F.col("is_hot"), F.col("anchor"))).alias("hot")
    )
    some = written(pieces(texts.join(wanted, "key")), folder, "pieces")

    shards = some.where("not hot").groupBy("shard", "digest").agg(F.any_value("words").alias("words"), F.sum("copies").alias("copies"))
    cold = matched(shards.repartition("shard").sortWithinPartitions("shard"))
    found = some.where("not hot").select("key", "shard", "digest", "starts").join(cold, ["shard", "digest"])
    # every repeated window of the stretch, at every start of the stretch
    found = found.select("key", F.flatten(F.transform("starts", lambda s: F.transform("windows", lambda w: w + s))).alias("at"))
    many = some.where("hot").groupBy("digest").agg(F.sum("copies").alias("copies")).where("copies > 1").select("digest")
    found = found.union(some.where("hot").select("key", "digest", "starts").join(many, "digest").select("key", "starts"))
    marks = found.groupBy("key").agg(F.flatten(F.collect_list("at")).alias("marks"))
    done = removed(texts.join(marks, "key", "left"))
    return keyed.select("doc_id", "key").join(done, "key").select("doc_id", "n_words", "n_removed", "kept_sha256")
