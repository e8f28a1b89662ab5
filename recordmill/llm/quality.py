"""Quality rules with line labels: a linear-chain conditional random field marks each line as content or boilerplate."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from recordmill.llm.common import let_go, pieces, sample
from recordmill.llm.crf import gradients, viterbi

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Parameters: the labelled rows used for fitting, and the least share of content.
SAMPLE_ROWS = 1000
MIN_CONTENT = 0.5
CHUNK = 64  # lines of one training sequence
STRETCH = 16  # most lines that a mixed training sequence takes from one document at a time

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, content_share double"
)


@dataclass
class LineModel:
    weights: np.ndarray  # features x (boilerplate, content)
    trans: np.ndarray
    start: np.ndarray


def _tables() -> dict[str, np.ndarray]:
    code = np.arange(0x250)
    text = [chr(c) for c in code]
    return {
        "word": np.array([c not in "\x20\t\n\x0b\x0c\r" for c in text]),
        "alpha": np.array([c.isalpha() for c in text]),
        "upper": np.array([c.isupper() for c in text]),
        "digit": np.array([c.isdigit() for c in text]),
        "symbol": np.array([c in SYMBOLS for c in text]),
        "shout": np.array([c == "!" for c in text]),
        "stop": np.array([c in ".,;:?" for c in text]),
    }


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every ``\\n``-separated line of every text, the characters in its words, and the lines of each text."""
    joined = "\n".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lines = joined.split("\n")
    sizes = np.array([t.count("\n") + 1 for t in texts])
    size = np.array([len(x) for x in lines], dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum(size + 1)])
    small = np.minimum(code, 0x24F)
    per = {}
    for name, table in _tables().items():
        total = np.concatenate([[0], np.cumsum(table[small], dtype=np.int64)])
        total = np.append(total, total[-1])  # the last line has no line end
        per[name] = total[edges[1:] - 1] - total[edges[:-1]]
    in_words = per["word"]
    line_words = [x.split() for x in lines]
    n_words = np.array([len(x) for x in line_words])
    fresh = np.array([len(set(x)) for x in line_words]) / np.maximum(n_words, 1)  # share of different words
    # how often a line with words occurs in its own text, and whether it did before
    again, times = np.zeros(len(lines), dtype=bool), np.ones(len(lines), dtype=np.int64)
    at = 0
    for n in sizes:
        if n > 1:
            own = lines[at : at + n]
            count = Counter(own)
            if len(count) < n:
                times[at : at + n] = [count[x] for x in own]
                seen: set[str] = set()
                for i, x in enumerate(own, at):
                    again[i] = x in seen
                    seen.add(x)
        at += n
    times[in_words == 0] = 1
    chars = np.maximum(in_words, 1)
    share = {k: v / chars for k, v in per.items()}
    columns = [
        np.ones(len(lines), dtype=bool),
        share["symbol"] > 0,
        share["symbol"] > 0.05,
        share["symbol"] > 0.2,
        share["upper"] > 0.3,
        share["upper"] > 0.7,
        share["digit"] > 0.1,
        share["digit"] > 0.3,
        share["shout"] > 0.02,
        share["shout"] > 0.1,
        share["alpha"] < 0.6,
        share["alpha"] < 0.85,
        (share["stop"] > 0) & (share["stop"] < 0.1),
        n_words < 3,
        n_words < 8,
        in_words > 12 * np.maximum(n_words, 1),
        again,
        times > 1,
        times > 3,
        (times > 1) & (n_words < 8),
        (n_words > 3) & (fresh < 0.7),
        (n_words > 3) & (fresh < 0.4),
        in_words == 0,
    ]
    return np.stack(columns, 1).astype(np.float64), in_words, sizes


def mixtures(texts: list[str], labels: list[int], seed: int = 0) -> tuple[list[str], np.ndarray]:
    """Texts joined from stretches of lines of good (1) and bad (0) documents in turn, and the label of every line.

    A stretch is 1 to ``STRETCH`` lines of one document; each is used at least once, those of the rarer kind again
    until those of the other kind are used up.
    """
    rng = np.random.default_rng(seed)
    stretches: tuple[list[list[str]], ...] = ([], [])
    for text, label in zip(texts, labels):
        lines, at = text.split("\n"), 0
        while at < len(lines):
            n = int(rng.integers(1, STRETCH + 1))
            stretches[label].append(lines[at : at + n])
            at += n
    for of_kind in stretches:
        rng.shuffle(of_kind)
    joined, marks, used, kind = [], [], [0, 0], 0
    while min(map(len, stretches)) and any(u < len(s) for u, s in zip(used, stretches)):
        lines: list[str] = []
        kind = int(rng.integers(2))
        for _ in range(int(rng.integers(2, 6))):
            stretch = stretches[kind][used[kind] % len(stretches[kind])]
            lines += stretch
            marks += [kind] * len(stretch)
            used[kind] += 1
            kind = 1 - kind
        joined.append("\n".join(lines))
    return joined, np.array(marks, dtype=np.int64)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = 60) -> LineModel:
    """Fit on at most ``sample_rows`` labelled documents, taken in order of a hash of the id.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality. Lines of good documents count as content, lines
    of bad ones as boilerplate. Rows without a text or a label are left out; with labels of one kind only, or none,
    every line counts as content.
    """
    known = labels.where("quality is not null").select("doc_id", "quality")
    rows = sample(docs.where("text is not null").select("doc_id", "text"), known, sample_rows).collect()
    return fitted([r.text for r in rows], [int(r.quality == 1) for r in rows], epochs)


def fitted(texts: list[str], labels: list[int], epochs: int = 60) -> LineModel:
    """The field for texts with labels 1 (content) and 0 (boilerplate).

    It learns from the whole texts, whose lines share a label, and from mixtures of them, where the label changes from
    stretch to stretch; so the transitions know both how long a kind lasts and that it ends.
    """
    n_features = line_features([""])[0].shape[1]
    weights, trans, start = np.zeros((n_features, 2)), np.zeros((2, 2)), np.zeros(2)
    if len(set(labels)) < 2:
        weights[0, 1] = 1.0
        return LineModel(weights, trans, start)
    mixed, marks = mixtures(texts, labels)
    features, _, sizes = line_features([*texts, *mixed])
    label = np.concatenate([np.repeat(labels, sizes[: len(texts)]), marks])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    starts = np.concatenate([np.arange(f, f + n, CHUNK) for f, n in zip(first, sizes)])
    ends = np.concatenate([np.minimum(np.arange(f, f + n, CHUNK) + CHUNK, f + n) for f, n in zip(first, sizes)])
    steps = int((ends - starts).max())
    index = np.minimum(starts[:, None] + np.arange(steps), len(label) - 1)
    mask = starts[:, None] + np.arange(steps) < ends[:, None]
    x, y = features[index] * mask[:, :, None], label[index] * mask
    params = [weights, trans, start]
    slope = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1):
        d_emit, d_trans, d_start = gradients(x @ weights, mask, y, trans, start)
        for p, m, v, g in zip(params, slope, square, (np.einsum("btf,btk->fk", x, d_emit), d_trans, d_start)):
            g = g - 1e-4 * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineModel(weights, trans, start)


def content_share(texts: list[str], model: LineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: lines, characters in words, and those in content lines."""
    features, chars, sizes = line_features(texts)
    tags = viterbi(features @ model.weights, sizes, model.trans, model.start)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return sizes, np.add.reduceat(chars, first), np.add.reduceat(chars * tags, first)


def base_rules(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in "\x20\t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").split()]
    again = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        count = Counter(windows)
        end = 0  # words before this are counted
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return n, word_chars, symbols, again, repeated


def _measured(texts: list[str], model: LineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the base values, the share of content, and whether the base rules fail."""
    base = np.array([base_rules(t) for t in texts], dtype=np.int64)
    _, chars, content = content_share(texts, model)
    failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
    return base, content / np.maximum(chars, 1), failed


def judged(docs: DataFrame, model: LineModel, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read), with the columns of ``SCHEMA``.

    A null or empty text has no words and fails the base rules; repeated rows are judged one by one; an empty
    table gives an empty table. ``kept`` is false where the base rules fail; else the share of the characters of
    words that stand in content lines must reach ``min_content``.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for a, b in pieces(texts):
                base, share, failed = _measured(texts[a:b], model)
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[a:b].astype("Int64").reset_index(drop=True),
                        "n_words": base[:, 0],
                        "word_chars": base[:, 1],
                        "n_symbols": base[:, 2],
                        "n_dup_lines": base[:, 3],
                        "n_repeat_words": base[:, 4],
                        "base_failed": failed,
                        "kept": ~failed & (share >= min_content),
                        "n_lines": [t.count("\n") + 1 for t in texts[a:b]],
                        "content_share": share,
                    }
                )

    return docs.select("doc_id", "text").mapInPandas(judge, SCHEMA)


def filtered(docs: DataFrame, model: LineModel, min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs`` that ``judged`` would keep, with all their columns; no shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            kept = []
            for a, b in pieces(texts):
                _, share, failed = _measured(texts[a:b], model)
                kept += (~failed & (share >= min_content)).tolist()
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
