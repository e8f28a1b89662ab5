"""The pipeline's stages, each on its own input, and the registered queries."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from recordmill.llm import queries, tokens
from recordmill.llm.common import read

from .conftest import ITEM, ROWS
from .test_operators import plain_hits, plain_links, plain_rules, plain_targets, shingles, words


class Texts(dict):
    """Texts by id, and with their sources."""

    def __init__(self, docs):
        rows = docs.select("doc_id", "text", "source").collect()
        super().__init__((r.doc_id, r.text) for r in rows)
        self.sources = {r.doc_id: (r.text, r.source) for r in rows}


def test_stages(spark, sf_dir, tmp_path):
    docs = read(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = (Texts(docs), out := spark.read.parquet(f"{tmp_path}/{name}"))
        docs = out
    before, after = seen["near_duplicates"]
    firsts = {c for _, c, _ in plain_links(list(before.items()))}
    assert sorted(r.doc_id for r in after.collect()) == sorted(firsts)
    before, after = seen["decontamination"]
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    where = {s: i for i, t in items for s in shingles(t)}
    bad = {
        d for d, t in before.items()
        if (near := {where[s] for s in shingles(t) if s in where}) and plain_hits(t, [x for x in items if x[0] in near])
    }
    assert {r.doc_id for r in after.collect()} == set(before) - bad
    assert_mixed(*seen["mix"])
    assert_tokens(docs, corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir))


def assert_mixed(before, after):
    """Each source takes its target, to the size of its longest document; no document more than three times."""
    rows = after.select("doc_id", "text", "source").collect()
    source = {r.doc_id: r.source for r in rows}
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(before) and max(copies.values(), default=0) <= 3
    assert all(r.text == before[r.doc_id] for r in rows)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for d, (text, of) in before.sources.items():
        sizes[of] += len(words(text))
        taken[of] += copies[d] * len(words(text))
        longest[of] = max(longest[of], len(words(text)))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = plain_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    assert set(source.values()) <= set(sizes) and all(abs(taken[s] - want[s]) <= longest[s] for s in sizes)


def assert_tokens(docs, got):
    """The rows of the token files, from a tokenizer that the operator has not touched."""
    fresh = Tokenizer.from_file(tokens.tokenizer_path())
    start, want = 0, []
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        ids = [*fresh.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows", [ROWS, []], ids=["edge cases", "no rows"])
def test_run_equals_its_stages(spark, docs, tmp_path, rows):
    """``run`` gives what the stages give one after the other, on odd rows and on an empty table."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None if i == 5 else "en", s, None if t is None else len(t)) for i, t, s in rows]
    sf_dir = f"{tmp_path}/given"
    tables = {
        "documents": spark.createDataFrame(rows, columns),
        "labels": spark.createDataFrame([(i, int(i != 13), 0) for i, *_ in rows][:16], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{sf_dir}/{name}.parquet")
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    stage_docs, kept = read(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, stage_docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        stage_docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in stage_docs.collect()}
    assert_tokens(stage_docs, got)
    if rows:
        assert kept["quality_rules"] == {i for i, t, *_ in rows if i != 13 and not plain_rules(t)[-1]}
        assert len(kept["near_duplicates"]) < len(kept["quality_rules"]) and kept["mix"]
    else:
        assert not any(kept.values()) and got.collect() == []


def test_near_duplicates_without_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [
        (None, long + " end"), (None, long + " stop"), (1, long), (None, other), (None, other + " x"), (7, None), (None, None), (None, None),
        (9, "one id"), (9, "two texts of it"), (9, "one id"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, mark string")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), "").collect()), key=str)
    assert [t for i, t in kept if t and t.startswith("w")] == [long]
    assert len([t for _, t in kept if t and t.startswith("v")]) == 1
    assert [(i, t) for i, t in kept if not t or " " in t and t[0] in "ot"] == [(7, None), (9, "one id"), (9, "two texts of it"), (None, None)]


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, sf_dir, name):
    table = "pages" if name == "op7_warc" else "documents"
    assert entry_points.queries()[name](spark, sf_dir).count() == read(spark, sf_dir, table).count()
