"""Surrogate keys and content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key rule. The separator is a control character, and
# the token keeps null apart from the empty text.
KEY_SEPARATOR = "\u001f"
NULL_TOKEN = "\u001enull"


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """md5 of the text of typed columns; equal rows give equal keys on any run."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def text_hash(c: Column | str) -> Column:
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)
