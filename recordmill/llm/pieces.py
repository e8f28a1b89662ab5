"""Long texts in pieces, so that a task holds the words of one piece at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

STEP = 1 << 20  # bytes of a piece; a piece ends at the first gap behind them


def pieces(raw: bytes, gap: re.Pattern[bytes], step: int = STEP) -> Iterator[bytes]:
    """``raw`` cut before bytes that match ``gap``, so that no run of other bytes is cut."""
    at = 0
    while at < len(raw):
        end = len(raw)
        if at + step < end and (found := gap.search(raw, at + step)):
            end = found.start()
        yield raw[at:end]
        at = end
