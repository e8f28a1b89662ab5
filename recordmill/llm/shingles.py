"""Word shingles of whole batches of texts as 64-bit numbers, and their MinHash values; numpy throughout."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse among 64-bit numbers
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finisher of a well-known generator)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number per word of all texts, end to end, and the number of words of each text.

    A word's number is a polynomial of its bytes, taken from running sums over all bytes at once.
    """
    data = b"\n".join([t.encode("utf-8", "surrogatepass") for t in texts])
    sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
    code = np.frombuffer(data + b"\n", dtype=np.uint8)
    blank = _BLANK[code]
    edge = np.diff(blank.astype(np.int8), prepend=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    end = end[-len(start) :] if len(start) else end[:0]
    power = _powers(_BASE, len(code))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    back = _powers(_INVERSE, len(code))
    numbers = mixed((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
    text_ends = np.cumsum(np.array(sizes, dtype=np.int64) + 1)
    return numbers, np.diff(np.searchsorted(start, text_ends, side="left"), prepend=0)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text. A text of fewer than ``width`` words has one shingle of all its words,
    a text without words none."""
    numbers, counts = word_numbers(texts)
    ends = np.cumsum(counts)
    some = numbers.copy()
    for i in range(1, width):
        rest = len(some) - i
        if rest > 0:
            some[:rest] = mixed(some[:rest] * np.uint64(_BASE) + numbers[i:])
    out = []
    for a, b in zip(ends - counts, ends):
        if b - a >= width:
            out.append(np.unique(some[a : b - width + 1]))
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64)
            for w in numbers[a:b]:
                one = mixed(one * np.uint64(_BASE) + w)
            out.append(one)
        else:
            out.append(numbers[:0])
    return out


def min_hashes(sets: list[np.ndarray], n: int, seed: int = 1) -> np.ndarray:
    """``n`` 16-bit MinHash values of each set; an empty set gets zeros.

    The smallest product picks a shingle; 16 bits of that product's scramble name it.
    """
    factors = np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sets), n), dtype=np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        some, size = [], 0
        while at < len(full) and (not some or size < 1 << 16):
            some.append(full[at])
            size += len(sets[full[at]])
            at += 1
        every = np.concatenate([sets[i] for i in some])
        first = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])[:-1]])
        for j, f in enumerate(factors):
            out[some, j] = (mixed(np.minimum.reduceat(every * f, first)) >> np.uint64(48)).astype(np.uint16)
    return out
