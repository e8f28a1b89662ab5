"""Language identification with a string kernel.

Two pieces of text are compared by the n-grams of characters that both hold, of one to three characters, whatever their
number of occurrences: a blended-spectrum presence kernel, divided by both norms. Landmarks drawn from the learning
rows span a Nyström feature space, in which one kernel ridge regression per language against the rest is solved. What a
piece scores is then one product of matrices: presence of n-grams times landmarks, scaled, times coefficients.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.common import sample

ORDER = 3  # longest n-gram
WINDOW = 1024  # characters of a piece; a text is all its pieces
TABLE_BITS = 14  # n-grams are counted as present in one of 2^14 hashed places
BATCH = 128  # pieces of one matrix product

# Bounds of what is learnt from.
ROWS_PER_LANGUAGE = 250
SAMPLE_ROWS = 4000
PIECES_PER_ROW = 4
LANDMARKS = 128
RIDGE = 1e-3
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class LanguageModel:
    languages: list[str]
    places: np.ndarray  # (2^TABLE_BITS, landmarks), presence over the landmark's norm
    coefficients: np.ndarray  # (landmarks, languages)


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def presence(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Presence of n-grams in short texts, as (texts, places), and the letters of each text.

    Letters are folded to lower case, anything else is a gap; n-grams of gaps only do not count.
    """
    folded = [t.lower() for t in texts]
    sizes = np.array([len(t) + ORDER - 1 for t in folded])
    sizes[0] += ORDER - 1  # gaps stand before the first text as well
    code = np.frombuffer((" " * (ORDER - 1)).join(["", *folded, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letter[code]
    code = np.where(is_letter, code, 32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), sizes)
    out = np.zeros((len(texts), 1 << TABLE_BITS), dtype=np.float32)
    gram, live = np.zeros(len(code), dtype=np.uint64), np.zeros(len(code), dtype=bool)
    for n in range(1, ORDER + 1):
        # the n-gram that ends at each place; those that reach into the text before hold its gap
        gram = np.concatenate([np.zeros(1, np.uint64), gram[:-1]]) if n > 1 else gram
        gram = gram * np.uint64(0x110001) + code + np.uint64(1)
        live = is_letter | (np.concatenate([[False], live[:-1]]) if n > 1 else False)
        mixed = gram * np.uint64(0x9E3779B97F4A7C15)
        place = (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out[row[live], place[live]] = 1.0
    return out, np.bincount(row, weights=is_letter, minlength=len(texts))


def _scaled(found: np.ndarray) -> np.ndarray:
    return found / np.sqrt(np.maximum(found.sum(1, keepdims=True), 1))


def learned(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE, seed: int = 0) -> LanguageModel:
    """Fit on short texts with their languages. Landmarks are drawn in turn from the languages."""
    names = sorted(set(languages))
    if not names:
        return LanguageModel([], np.zeros((1 << TABLE_BITS, 1), np.float32), np.zeros((1, 0)))
    kind = np.array([names.index(x) for x in languages])
    r = np.random.default_rng(seed)
    queues = [r.permutation(np.flatnonzero(kind == k)) for k in range(len(names))]
    order = [q[i] for i in range(max(map(len, queues))) for q in queues if i < len(q)]
    chosen = np.array(order[:landmarks])
    letter = letters()
    marks = _scaled(presence([texts[i] for i in chosen], letter)[0])
    between = marks.astype(np.float64) @ marks.T
    kernel = np.concatenate(
        [_scaled(presence(texts[i : i + BATCH], letter)[0]) @ marks.T for i in range(0, len(texts), BATCH)]
    ).astype(np.float64)
    # Nystroem: k(x, landmarks) times the inverse root of k(landmarks, landmarks)
    values, vectors = np.linalg.eigh(between)
    used = values > 1e-8 * values.max()
    root = vectors[:, used] / np.sqrt(values[used])
    space = kernel @ root
    goal = np.where(kind[:, None] == np.arange(len(names)), 1.0, -1.0)
    weights = np.linalg.solve(space.T @ space + ridge * len(texts) * np.eye(space.shape[1]), space.T @ goal)
    return LanguageModel(names, np.ascontiguousarray(marks.T), root @ weights)


def _pieces_of(text: Column) -> Column:
    """Pieces at even distances over a whole text, and one short one, for learning."""
    at = F.transform(F.sequence(F.lit(0), F.lit(PIECES_PER_ROW - 1)), lambda i: F.floor(i * F.length(text) / PIECES_PER_ROW).cast("int"))
    long = F.transform(at, lambda i: F.substring(text, i + 1, F.lit(WINDOW)))
    short = F.transform(at, lambda i: F.substring(text, i + 1, F.lit(48)))
    return F.array_distinct(F.concat(long, short))


def in_fold(doc_id: Column, fold: int = 1, folds: int = 3) -> Column:
    """Whether crc32 of an id's text falls into a fold; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from text and lang of rows outside the held-out fold, with neither of both null.

    The sample has at most ``rows_per_language`` rows a language and ``sample_rows`` in all, in order of a hash of
    the id; of a row ``2 * PIECES_PER_ROW`` pieces at even distances are learnt from. Rows without an id teach nothing.
    """
    known = docs.where("doc_id is not null and text is not null and lang is not null").where(~in_fold(F.col("doc_id")))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    keys = known.select("doc_id", "lang").withColumn("at", F.row_number().over(by_hash)).where(F.col("at") <= rows_per_language)
    # every language comes in before any has its second row
    keys = keys.orderBy("at", "lang", "doc_id").limit(sample_rows).select("doc_id").distinct()
    rows = sample(known.select("doc_id", F.col("lang").cast("string").alias("lang"), _pieces_of(F.col("text")).alias("pieces")), keys, sample_rows)
    found = [(p, r.lang) for r in rows.collect() for p in r.pieces if any(c.isalpha() for c in p)]
    return learned([p for p, _ in found], [x for _, x in found])


def _windows(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """All pieces of all texts, ``BATCH`` at a time, with the index of their text."""
    index: list[int] = []
    held: list[str] = []
    for i, text in enumerate(texts):
        for at in range(0, len(text), WINDOW):
            index.append(i)
            held.append(text[at : at + WINDOW])
            if len(held) == BATCH:
                yield index, held
                index, held = [], []
    if held:
        yield index, held


def scores(texts: list[str], model: LanguageModel, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the mean score of each language over its pieces, by their letters, and its letters."""
    total, count = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for index, held in _windows(texts):
        found, n_letters = presence(held, letter)
        kernel = (found @ model.places) / np.sqrt(np.maximum(found.sum(1, keepdims=True), 1))
        np.add.at(total, index, (kernel @ model.coefficients) * n_letters[:, None])
        np.add.at(count, index, n_letters)
    return total / np.maximum(count, 1)[:, None], count


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read), with the columns of ``SCHEMA``.

    Every character of a text is read. A null text, one without a letter, and any text if nothing was learnt are
    ``und`` with score 0; of languages with equal scores the first by name is taken. ``score`` is the regression's
    value for the language brought from [-1, 1] to [0, 1]. A row without an id is never held out; repeated rows are
    judged one by one; an empty table gives an empty table.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters()
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            value, count = scores(texts, model, letter)
            if model.languages:
                best = value.argmax(1)
                top = np.clip((value[np.arange(len(texts)), best] + 1) / 2, 0, 1)
                names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, count)]
                top = np.where(count > 0, top, 0.0).round(6)
            else:
                names, top = [UNKNOWN] * len(texts), np.zeros(len(texts))
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(top)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), in_fold(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(judge, SCHEMA)
