"""Personal data: fixed base patterns, and a character BiLSTM with CRF transitions that adds spans.

The network is trained in numpy on labelled spans. It reads overlapping windows; where windows overlap, their
tag scores are blended by the distance from the window's edge, and one Viterbi pass over each chain of windows
settles the tags.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import sample
from recordmill.llm.crf import gradients, viterbi
from recordmill.llm.spans import Span, apart, digest, listed, ordered

# Kinds and base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Parameters of the network and its training.
WINDOW = 96  # of training
READ, SHARED = 384, 48  # characters of a window that is read, and those it shares with the next
STEP = READ - SHARED
HELD = 1008 * STEP  # characters whose scores are held at a time
HIDDEN = 12
SAMPLE_ROWS = 200  # rows of the table whose base spans are added to the training texts
EPOCHS = 18
BATCH = 128
MIN_PROB = 0.6
CHUNK = 1024  # windows read side by side
PLAIN_EVERY = 16 * WINDOW  # characters from one training window of a text, taken wherever it falls, to the next

SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)
TRIGGER = re.compile("[0-9@]")
ADDRESS = re.compile(r"(@|\bat\b).*\.", re.S)  # what an added address holds at least
CHARS = "\x00 \n@.+-()_%:/,;!?\"'" + "abcdefghijklmnopqrstuvwxyz"
CLASSES = len(CHARS) + 4  # and capital, digit, other letter, other


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Each ``@`` with the longest run of allowed characters before it; linear in the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield "email", start, m.end()
            end = m.end()
        at = text.find("@", at + 1)


def _ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches per kind that do not overlap; failing matches go, without another try."""
    out = list(_emails(text)) if "@" in text else []
    if TRIGGER.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if _ip_ok(m.group())]
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return ordered(out, KINDS)


def _class_table() -> bytes:
    table = bytearray([CLASSES - 1] * 128 + [len(CHARS) + 2] * 128)
    for i, c in enumerate(CHARS):
        table[ord(c)] = i
    table[ord("A") : ord("Z") + 1] = bytes([len(CHARS)] * 26)
    table[ord("0") : ord("9") + 1] = bytes([len(CHARS) + 1] * 10)
    return bytes(table)


CLASS_OF = _class_table()


def char_classes(text: str) -> np.ndarray:
    """A class per character; those beyond Latin-1 are classed as its last one is."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        raw = np.minimum(code, 255).astype(np.uint8).tobytes()
    return np.frombuffer(raw.translate(CLASS_OF), dtype=np.uint8)


@dataclass
class Tagger:
    params: dict[str, np.ndarray]


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid; ``2 * _gate(2 * x) - 1`` is the piecewise linear tanh."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _lstm(gates_in: np.ndarray, recur: np.ndarray, keep: bool = False):
    """Hidden states (steps, batch, H) of one direction; gates in the order in, forget, out, new."""
    steps, n, _ = gates_in.shape
    size = recur.shape[0]
    h, c = np.zeros((n, size), gates_in.dtype), np.zeros((n, size), gates_in.dtype)
    out, tape = np.empty((steps, n, size), gates_in.dtype), []
    for t in range(steps):
        z = gates_in[t] + h @ recur
        s, g = _gate(z[:, : 3 * size]), np.clip(z[:, 3 * size :], -1, 1)
        before = c
        c = s[:, size : 2 * size] * c + s[:, :size] * g
        if keep:
            tape.append((h, before, s, g, c))
        h = s[:, 2 * size :] * np.clip(c, -1, 1)
        out[t] = h
    return out, tape


def _lstm_back(d_out: np.ndarray, recur: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients by the gate inputs and by the recurrent weights."""
    size = recur.shape[0]
    d_gates, d_recur = np.empty((*d_out.shape[:2], 4 * size)), np.zeros_like(recur)
    dh, dc = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
    for t in range(len(tape) - 1, -1, -1):
        h, before, s, g, c = tape[t]
        i, f, o = s[:, :size], s[:, size : 2 * size], s[:, 2 * size :]
        dh = dh + d_out[t]
        dc = dc + dh * o * (np.abs(c) < 1)
        d_sig = np.concatenate([dc * g, dc * before, dh * np.clip(c, -1, 1)], 1) * 0.25 * ((s > 0) & (s < 1))
        dz = np.concatenate([d_sig, dc * i * (np.abs(g) < 1)], 1)
        d_gates[t] = dz
        d_recur += h.T @ dz
        dh, dc = dz @ recur.T, dc * f
    return d_gates, d_recur


def _run(weights: np.ndarray, recur: np.ndarray, steps: np.ndarray, out: np.ndarray) -> None:
    """Hidden states of one direction into ``out`` (steps, H, windows), without a tape: ``_lstm`` in buffers, with the
    gates' slopes and offsets in the weights, so that one clip makes all four."""
    size, n = recur.shape[0], steps.shape[1]
    slope = np.repeat(np.array([0.25, 0.25, 0.25, 0.5], np.float32), size)
    weights, recur = weights * slope + np.float32(0.5), np.ascontiguousarray((recur * slope).T)
    x, z = np.empty((n, 4 * size), np.float32), np.empty((4 * size, n), np.float32)
    h, c, new = np.zeros((size, n), np.float32), np.zeros((size, n), np.float32), np.empty((size, n), np.float32)
    low, high = np.float32(0), np.float32(1)
    for t, codes in enumerate(steps):
        np.matmul(recur, h, out=z)
        z += np.take(weights, codes, axis=0, out=x, mode="clip").T
        np.clip(z, low, high, out=z)
        g = z[3 * size :]
        g *= 2
        g -= 1
        g *= z[:size]
        c *= z[size : 2 * size]
        c += g
        np.clip(c, -high, high, out=new)
        h = np.multiply(z[2 * size : 3 * size], new, out=out[t])


def _emissions(p: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Tag scores (windows, steps, tags) of windows of character classes."""
    steps = np.ascontiguousarray(ids.T, dtype=np.intp)
    size = p["re_f"].shape[0]
    both = np.empty((len(steps), 2 * size, len(ids)), np.float32)
    _run(p["in_f"], p["re_f"], steps, both[:, :size])
    _run(p["in_b"], p["re_b"], steps[::-1], both[::-1, size:])
    return np.matmul(p["out"].T, both).transpose(2, 0, 1) + p["bias"]


def _synthetic(n: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Texts with personal data in many writings, and with numbers that are none."""
    r = random.Random(seed)

    def word(low: int = 2, high: int = 9) -> str:
        w = "".join(r.choice("etaoinsrhldcumfpgwybvk") for _ in range(r.randint(low, high)))
        return r.choice([w, w, w, w.capitalize(), w + ",", w + "."])

    def plain(low: int = 3, high: int = 8) -> str:
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(low, high)))

    def number(k: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        d = [int(x) for x in "4" + number(14)]
        d.append(next(x for x in range(10) if luhn([*d, x])))
        t = "".join(map(str, d))
        return r.choice([t, t, "-".join(t[i : i + 4] for i in range(0, 16, 4)), " ".join(t[i : i + 4] for i in range(0, 16, 4))])

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"+{number(2)} {a} {b}{c}", f"+1-{a}-{b}-{c}", f"+1.{a}.{b}.{c}"])

    def email() -> str:
        at = r.choice(["@", "@", "@", " @ ", " at "])
        return f"{plain()}{r.choice(['.', '_', ''])}{r.choice([number(2), plain()])}{at}{plain()}{r.choice(['', number(1)])}.{r.choice(['com', 'org', 'example.com', 'net'])}"

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def nothing() -> str:
        return r.choice([f"{r.randint(1, 9)}.{r.randint(0, 9)}.", number(r.randint(1, 7)), f"{r.randint(0, 23)}:{number(2)}", f"version {number(1)}.{number(1)}.{number(1)}",
                         f"19{number(2)}-{number(2)}-{number(2)}", f"AKIA{number(4)}{plain(12, 12).upper()}", f"password={number(5)}{plain()}", f'"{number(9)}{plain(5, 5)}{number(9)}"', f"@{plain()}", f"{number(3)},{number(3)}", f"{plain()}.{r.choice(['com', 'org', 'log', 'txt'])}", f"www.{plain()}.{plain()}.net",
                         f"v{number(1)}.{number(2)}.{number(1)}-{plain(2, 4)}", f"{plain(2, 2).upper()}{number(2)} " + " ".join(number(4) for _ in range(5)) + f" {number(2)}"])

    make = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(n):
        text, spans = word(), []
        while len(text) < WINDOW - 30:
            kind = r.choice([*KINDS, "", "", "", "no"])
            text += " "
            if kind in make:
                value = make[kind]()
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + r.choice(["", "", ".", ","])
            else:
                text += nothing() if kind else " ".join(word() for _ in range(r.randint(1, 4)))
        out.append((text, spans))
    return out


def _worded(n: int, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Prose with addresses that hold neither a digit nor ``@``, and with an ``at`` that makes none."""
    r = random.Random(seed)

    def plain(low: int, high: int) -> str:
        letters = r.choice(["abcdefghijklmnopqrstuvwxyz", "etaoinsrhldcumfpgwybvk"])
        return "".join(r.choice(letters) for _ in range(r.randint(low, high)))

    def prose(low: int, high: int) -> str:
        return " ".join(plain(2, 9) + r.choice(["", "", "", "", "", ",", ".", " at"]) for _ in range(r.randint(low, high)))

    out = []
    for _ in range(n):
        text, spans = prose(1, 6), []
        if r.random() < 0.7:
            name = plain(3, 9) + (f"{r.choice('._')}{plain(3, 9)}" if r.random() < 0.85 else "")
            value = f"{name} at {plain(3, 9)}.{r.choice(['com', 'org', 'example.com', 'net'])}"
            text += " "
            spans.append(("email", len(text), len(text) + len(value)))
            text += value + r.choice(["", "", ".", ","])
        out.append((f"{text} {prose(8, 16)}", spans))
    return out


def training_windows(texts: list[str], synthetic: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character classes and their tags (0: none), from generated texts and from the base spans of ``texts``."""
    labelled = _synthetic(synthetic) + _worded(synthetic * 3 // 4)
    for text in texts:
        spans = base_spans(text)
        near = [max(0, m.start() - WINDOW // 2) for m in list(TRIGGER.finditer(text))[:: WINDOW // 2]]
        for a in [*near, *range(0, len(text), PLAIN_EVERY)]:
            labelled.append((text[a : a + WINDOW], [(k, x - a, y - a) for k, x, y in spans if x < a + WINDOW and y > a]))
    ids, tags = np.zeros((len(labelled), WINDOW), dtype=np.int64), np.zeros((len(labelled), WINDOW), dtype=np.int64)
    for i, (text, spans) in enumerate(labelled):
        c = char_classes(text)[:WINDOW]
        ids[i, : len(c)] = c
        for k, a, b in spans:
            tags[i, max(0, a) : max(0, b)] = 1 + KINDS.index(k)
    return ids, tags


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS, hidden: int = HIDDEN) -> Tagger:
    """Train on generated labelled texts and on the base spans of at most ``sample_rows`` rows of the table, taken
    in order of a hash of the id from those that hold a digit or ``@``."""
    held = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    rows = sample(held, held.select("doc_id"), sample_rows).collect()
    ids, tags = training_windows([r.text for r in rows])
    r = np.random.default_rng(3)
    k = len(KINDS) + 1
    p = {
        "in_f": r.normal(0, 0.3, (CLASSES, 4 * hidden)), "in_b": r.normal(0, 0.3, (CLASSES, 4 * hidden)),
        "re_f": r.normal(0, 0.2, (hidden, 4 * hidden)), "re_b": r.normal(0, 0.2, (hidden, 4 * hidden)),
        "out": r.normal(0, 0.2, (2 * hidden, k)), "bias": np.zeros(k), "trans": np.zeros((k, k)), "start": np.zeros(k),
    }
    slope, square = ({n: np.zeros_like(v) for n, v in p.items()} for _ in range(2))
    one = np.eye(CLASSES)
    mask = np.ones((BATCH, WINDOW), dtype=bool)
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(r.permutation(len(ids)), max(1, len(ids) // BATCH)):
            step += 1
            steps = ids[batch].T
            ahead, tape_f = _lstm(p["in_f"][steps], p["re_f"], True)
            behind, tape_b = _lstm(p["in_b"][steps[::-1]], p["re_b"], True)
            both = np.concatenate([ahead, behind[::-1]], 2)
            emit = (both @ p["out"] + p["bias"]).transpose(1, 0, 2)
            live = mask if len(batch) == BATCH else np.ones((len(batch), WINDOW), dtype=bool)
            d_emit, d_trans, d_start = gradients(emit, live, tags[batch], p["trans"], p["start"])
            d_emit = d_emit.transpose(1, 0, 2)
            d_both = d_emit @ p["out"].T
            d_f, d_re_f = _lstm_back(d_both[:, :, :hidden], p["re_f"], tape_f)
            d_b, d_re_b = _lstm_back(d_both[::-1, :, hidden:], p["re_b"], tape_b)
            grad = {"re_f": d_re_f, "re_b": d_re_b, "trans": d_trans, "start": d_start}
            grad |= {"out": np.einsum("tbh,tbk->hk", both, d_emit), "bias": d_emit.sum((0, 1))}
            for name, d, s in (("in_f", d_f, steps), ("in_b", d_b, steps[::-1])):
                grad[name] = one[s.reshape(-1)].T @ d.reshape(-1, 4 * hidden)
            norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
            for name, g in grad.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                slope[name] += 0.1 * (g - slope[name])
                square[name] += 0.001 * (g * g - square[name])
                p[name] += 0.03 * (slope[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
    return Tagger({n: v.astype(np.float32) for n, v in p.items()})


def _open(scores: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places that a best path may tag other than 0, of texts end to end.

    A stretch of other tags gains at most the sum of its places' gains less what entering and leaving it costs. The
    best sum of any stretch through a place is a difference of running sums: the highest behind it less the lowest
    before it.
    """
    enter, leave = trans[0, 0] - trans[0, 1:].max(), trans[0, 0] - trans[1:, 0].max()
    inner = trans[1:, 1:].max() - trans[0, 0]
    gain = (scores[:, 1:].max(1) - scores[:, 0]).astype(np.float64) + inner
    ends = np.cumsum(sizes)
    real = sizes > 0
    first, last = (ends - sizes)[real], ends[real] - 1
    gain[first] += enter + (start[1:] - start[0]).max()
    gain[last] += leave
    if not len(gain):
        return np.zeros(0, dtype=bool)
    total = np.cumsum(gain)
    before = total - gain
    # no stretch runs over the end of a text: every text's sums lie below those of the one before
    lowest = np.minimum(np.minimum.reduceat(before, first), np.minimum.reduceat(total, first)) - before[first]
    highest = np.maximum(np.maximum.reduceat(total, first) - before[first], 0)
    drop = np.concatenate([[0.0], np.cumsum(lowest[:-1] - highest[1:] - 1)]) - before[first]
    drop = np.repeat(drop, sizes[real])
    total, before = total + drop, before + drop
    best = np.maximum.accumulate(total[::-1])[::-1] - np.minimum.accumulate(before)
    return best >= inner + enter + leave - 1e-3


def _settled(scores: np.ndarray, sizes: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best tags of texts end to end, as ``viterbi`` finds them.

    Places that no best path tags other than 0 cut the texts into short pieces that are decoded side by side, each
    between tags 0.
    """
    free = _open(scores, sizes, trans, start)
    tags = np.zeros(len(scores), dtype=np.int64)
    edge = np.zeros(len(scores) + 1, dtype=bool)
    edge[np.concatenate([[0], np.cumsum(sizes)])] = True
    first = free & (edge[:-1] | ~np.concatenate([[False], free[:-1]]))
    last = free & (edge[1:] | ~np.concatenate([free[1:], [False]]))
    at = np.flatnonzero(free)
    own = scores[at]
    inner = first & ~edge[:-1]
    own[inner[at]] += trans[0] - start
    own[(last & ~edge[1:])[at]] += trans[:, 0]
    tags[at] = viterbi(own, np.flatnonzero(last) - np.flatnonzero(first) + 1, trans, start)
    return tags


def _free(scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places where another tag than 0 could make up for its lower score by its transitions on both sides."""
    into = np.maximum((trans - trans[:, :1]).max(0), start - start[0])
    from_ = np.maximum((trans - trans[:1]).max(1), 0)
    lead = scores[:, 0] - 1e-3
    free = np.zeros(len(scores), dtype=bool)
    for k in range(1, scores.shape[1]):
        free |= scores[:, k] + (into + from_)[k] >= lead
    return free


def _blended(texts: list[str], p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores of all characters of the texts end to end, and the texts' sizes. All windows of a text are read;
    where two windows share characters, each counts the more the farther its edge is."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // STEP)  # a window begins at every STEP-th character
    windows = np.zeros((counts.sum(), READ), dtype=np.uint8)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        if n:
            ids = np.zeros((n - 1) * STEP + READ, dtype=np.uint8)
            ids[: len(text)] = char_classes(text)
            windows[at : at + n] = np.lib.stride_tricks.sliding_window_view(ids, READ)[::STEP]
            at += n
    tags = len(p["bias"])
    scores = np.empty((sizes.sum(), tags), np.float32)
    emit = np.empty((len(windows), READ, tags), np.float32)
    for j in range(0, len(windows), CHUNK):
        emit[j : j + CHUNK] = _emissions(p, windows[j : j + CHUNK])
    share = (np.arange(1, SHARED + 1, dtype=np.float32) / (SHARED + 1))[:, None]
    at = to = 0
    for size, n in zip(sizes.tolist(), counts.tolist()):
        if n:
            own = emit[at : at + n]
            own[1:, :SHARED] = own[1:, :SHARED] * share + own[:-1, STEP:] * share[::-1]
            scores[to : to + size] = np.concatenate([own[:, :STEP].reshape(-1, tags), own[-1, STEP:]])[:size]
            at += n
            to += size
    return scores, sizes


def _parts(texts: list[str], p: dict[str, np.ndarray]) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """All texts, ``HELD`` characters at a time: index and first character of each piece, and the pieces' scores and
    sizes. A longer text is cut where its tag is 0 on any path, so that its pieces are decoded as the whole is."""
    index: list[int] = []
    held = 0
    for i, text in enumerate([*texts, None]):
        if index and (text is None or held + len(text) > HELD):
            yield index, [0] * len(index), *_blended([texts[k] for k in index], p)
            index, held = [], 0
        if text is None:
            return
        if len(text) <= HELD:
            index.append(i)
            held += len(text)
            continue
        begin, scores = 0, np.empty((0, len(p["bias"])), np.float32)
        for a in range(0, len(text), HELD):
            low = max(0, a - STEP)
            new = _blended([text[low : a + HELD + READ]], p)[0][a - low : a - low + HELD]
            scores = np.concatenate([scores, new])
            cut = len(scores)
            if a + HELD < len(text):
                settled = np.flatnonzero(~_free(scores, p["trans"], p["start"]))
                if not len(settled) or not settled[-1]:
                    continue
                cut = int(settled[-1])
            # the settled place ends one piece and begins the next
            piece = scores[: cut + 1]
            yield [i], [begin], piece, np.array([len(piece)])
            begin, scores = begin + cut, scores[cut:]


def tagged(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """The network's spans of each text. It reads the whole text; an address may be all words (``anna at post.org``),
    the numbers of the other kinds hold a digit."""
    p = tagger.params
    found: list[list[Span]] = [[] for _ in texts]
    for index, begins, scores, sizes in _parts(texts, p):
        if not len(scores):
            continue
        tags = _settled(scores, sizes, p["trans"], p["start"])
        ends = np.cumsum(sizes)
        cut = np.diff(tags, prepend=0) != 0
        cut[(ends - sizes)[sizes > 0]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(tags))
        for x, y in zip(first[tags[first] > 0].tolist(), last[tags[first] > 0].tolist()):
            i = int(np.searchsorted(ends, x, side="right"))
            text, kind = texts[index[i]], KINDS[tags[x] - 1]
            shift = begins[i] - int(ends[i] - sizes[i])
            s, e = x + shift, y + shift
            while s < e and text[s] in " \n\t.,;:\"'":
                s += 1
            while e > s and text[e - 1] in " \n\t.,;:\"'":
                e -= 1
            prob = np.exp(scores[x:y] - scores[x:y].max(1, keepdims=True))
            sure = float((prob[:, tags[x]] / prob.sum(1)).mean())
            if e - s >= 7 and sure >= MIN_PROB and (ADDRESS if kind == "email" else TRIGGER).search(text, s, e):
                found[index[i]].append((kind, s, e))
    return found


def detected(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read), with the columns of ``SCHEMA``.

    A null text counts as empty and has no spans; repeated rows are read one by one; an empty table gives an empty
    table. ``spans`` holds the base spans and the network's spans that touch none of them.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            rows = []
            for text, more in zip(texts, tagged(texts, tagger)):
                base = base_spans(text)
                every = ordered(base + apart(more, base), KINDS)
                rows.append((*(sum(s[0] == k for s in base) for k in KINDS), digest(base), listed(every), len(every) - len(base)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(each, SCHEMA)
