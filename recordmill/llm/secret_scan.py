"""Secret scan by assignment-aware lexing: names and literals of source and configuration text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from recordmill.llm.spans import Span, apart, digest, listed, ordered

# Kinds, base patterns and least sizes.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so the least size can stand in the pattern
MIN_ASSIGN, MIN_ACCESS = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "api")
HEX_THIRD = re.compile(r"[0-9a-f]{8}")

# Words of a name that make its value sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.8, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "private": 0.5, "api": 0.5, "access": 0.5, "auth": 0.5, "client": 0.2,
    "signing": 0.4, "encryption": 0.4, "key": 0.4, "salt": 0.3,
}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|changeme|example.*|your.*|<.*>|\$\{.*\}|%.*%|todo)$")
MIN_SCORE = 1.2
MIN_LITERAL = 8

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"

# One token of a line: a quoted literal, a name (dotted or indexed), a number or bare value, or one mark.
TOKEN = re.compile(
    r"""(?P<quoted>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*)|(?P<mark>=>|:=|==|!=|[=:+,;(){}\[\]#])|(?P<bare>[^\s"'=:+,;(){}\[\]#]+)"""
)
UNQUOTED = re.compile(r"""[^\s"',;(){}\[\]]+""")
# A type between a name and its value, from the colon to the value: ``: str = ``, ``: Optional[str] = ``.
TYPED = re.compile(
    r""":[ \t]*[&*]?(?:'\w+[ \t]+)?[A-Za-z_][\w.]*(?:\[[^="]{0,80}\]|<[^="]{0,80}>)?(?:[ \t]*\|[ \t]*[\w.]+|\?){0,8}(?:[ \t]+=[ \t]+|[ \t]*=[ \t]*(?=["']))"""
)
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[Span]:
    """Leftmost matches per kind that do not overlap; failing matches go, without another try."""
    out: list[Span] = []
    if ("=" in text or ":" in text) and any(map(text.lower().__contains__, KEYWORDS)):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # 24 characters in a row hold 8 of every third character in a row
    if HEX_THIRD.search(text[::3]):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(out, KINDS)


def name_score(name: str) -> float:
    return min(1.5, sum(SENSITIVE.get(p, 0.0) for p in {x.lower() for x in PART.findall(name)}))


def literal_score(value: str) -> float:
    """From 0 for plain words to about 1 for random text."""
    if len(value) < MIN_LITERAL or PLACEHOLDER.match(value):
        return 0.0
    count = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in count.values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    return min(1.0, entropy / 4) * (0.4 + 0.2 * classes) * (0.3 if " " in value.strip() else 1.0)


def literals(parts: list) -> dict[tuple[int, int], str]:
    """The literals of a value by their places, each once: a part is a literal (start, end, text) or the parts of
    another name, which all names that use it share."""
    out: dict[tuple[int, int], str] = {}
    seen, stack = {id(parts)}, [iter(parts)]
    while stack:
        for p in stack[-1]:
            if isinstance(p, tuple):
                out[p[0], p[1]] = p[2]
            elif id(p) not in seen:
                seen.add(id(p))
                stack.append(iter(p))
                break
        else:
            stack.pop()
    return out


def assignments(text: str) -> Iterator[tuple[str, list]]:
    """Target names with the parts of the value they get (see ``literals``), in order of the text.

    A line holding ``name = value``, ``name: value``, ``"name": "value"``, ``name => value`` or ``name: type = value``
    gives a pair; a sum of quoted literals and known names has the places of its parts and is scored as a whole;
    a value that is the name of an earlier literal hands that literal on to the new name. A value without quotes is
    one literal up to a blank, quote, comma, semicolon or bracket.
    """
    known: dict[str, list] = {}
    at = 0
    for line in text.split("\n"):
        if "=" in line or ":" in line:
            tokens = [(m.lastgroup, m.group(), at + m.start(), at + m.end()) for m in TOKEN.finditer(line)]
            for i in range(1, len(tokens) - 1):
                kind, mark, begin, _ = tokens[i]
                if kind != "mark" or mark not in ("=", ":", ":=", "=>"):
                    continue
                left = tokens[i - 1]
                if left[0] not in ("name", "quoted"):
                    continue
                name = left[1].strip("\"'")
                parts: list = []
                j = i + 1
                if mark == ":" and (typed := TYPED.match(line, begin - at)):
                    while j < len(tokens) and tokens[j][2] < at + typed.end():
                        j += 1
                while j < len(tokens):
                    k, value, a, b = tokens[j]
                    more = j + 2 < len(tokens) and tokens[j + 1][1] == "+" and (tokens[j + 2][0] == "quoted" or tokens[j + 2][1] in known)
                    if k == "quoted":
                        parts.append((a + 1, b - 1, value[1:-1]))
                    elif (run := UNQUOTED.match(line, a - at)) and (k != "mark" or (value == "+" and not parts)):
                        if value in known and (more or at + run.end() == b):
                            parts.append(known[value])
                        elif not parts:
                            parts.append((a, at + run.end(), run.group()))
                            break
                    else:
                        break
                    if not more:
                        break
                    j += 2
                if parts:
                    known[name] = parts
                    yield name, parts
        at += len(line) + 1


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans with those that the lexer adds (kind ``assign``)."""
    base = base_spans(text)
    added: set[Span] = set()
    if "=" in text or ":" in text:
        for name, parts in assignments(text):
            if target := name_score(name):
                found = literals(parts)
                score = literal_score("".join(found.values()))
                if target + score >= MIN_SCORE and score >= 0.5:
                    added.update(("assign", a, b) for a, b in found if b > a)
    return base, ordered(base + apart(list(added), base), KINDS)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read), with the columns of ``SCHEMA``.

    A null text counts as empty and has no spans; repeated rows are scanned one by one; an empty table gives an
    empty table. Base spans are those of the fixed patterns; ``spans`` holds them and what the lexer adds.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base, every = scan(text if isinstance(text, str) else "")
                rows.append((*(sum(s[0] == k for s in base) for k in KINDS), digest(base), listed(every), len(every) - len(base)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(each, SCHEMA)
