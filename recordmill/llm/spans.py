"""Spans of several kinds in a text: their order, their overlap and their digest."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]  # kind, start, end (code points, end exclusive)


def ordered(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()


def apart(new: list[Span], old: list[Span]) -> list[Span]:
    """The spans of ``new`` that touch none of ``old`` and none kept before them."""
    taken = sorted((a, b) for _, a, b in old)
    out = []
    i, last = 0, -1
    for k, a, b in sorted(new, key=lambda s: (s[1], s[2])):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a >= last and not any(x < b and a < y for x, y in taken[i : i + 4]):
            out.append((k, a, b))
            last = b
    return out
