"""Resampling, language identification and the filter audit against plain versions, on edge cases and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.llm import common, filter_audit, language, pieces, resampling

from .conftest import ROWS


# --- importance resampling ---------------------------------------------------------------------------------------


def plain_features(text, width=1):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return ws, [" ".join(ws[i : i + n]) for n in range(1, width + 1) for i in range(len(ws) - n + 1)]


def plain_draw(rows, target, width=1, percent=10):
    """(doc_id, n_features, weight, score, rank) of every row."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, t in rows for f in plain_features(t, width)[1])
    t = Counter(bucket(f) for x in target for f in plain_features(x, width)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        ws, fs = plain_features(text, width)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in map(bucket, fs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, None, len(ws)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted((tuple(r[:5]) for r in out), key=str)


EDGE = [
    *[(i, t) for i, t, _ in ROWS],
    *[(None, "the same words by many a row without an id, twenty of them at least, so that each of these can be drawn too")] * 30,
    *[(77, "one id on many rows, all of which have the same text and so the same score, and twenty words or more in it")] * 30,
    *[(-i, f"plain words number {i} " + "and some more of them " * (i % 7)) for i in range(40)],
]


@pytest.mark.parametrize("width,percent", [(1, 10), (1, 55), (2, 100), (3, 1)])
def test_resampling_equals_plain_draw(spark, width, percent):
    docs = spark.createDataFrame([(*r, 1.5) for r in EDGE], "doc_id long, text string, score double").repartition(4)
    target = spark.createDataFrame([("words of the target, number 3",), (None,)], "text string")
    got = resampling.resampled(docs, target, width=width, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_draw(EDGE, ["words of the target, number 3"], width, percent)


def test_resampling_of_empty_tables(spark, docs, no_docs):
    assert resampling.resampled(no_docs, docs).collect() == []
    rows = resampling.resampled(docs, no_docs).collect()
    assert sorted((tuple(r) for r in rows), key=str) == plain_draw([(i, t) for i, t, _ in ROWS], [])


def test_cutoff_is_the_kth_row(spark):
    r = np.random.default_rng(5)
    rows = sorted((int(a), int(b), i) for i, (a, b) in enumerate(r.integers(-3, 3, (300, 2)) * (10**17)))
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    for k in (1, 2, 49, 150, 299, 300):
        bound = resampling.cutoff(df, ["a", "b", "c"], k)
        assert df.where(resampling.at_most(["a", "b", "c"], bound)).count() == k
        assert tuple(bound) == rows[k - 1][: len(bound)]


def test_pieces_join_to_the_whole():
    raw = ("word " * 50 + "x" * 100 + " end").encode()
    for step in (1, 7, 60, 1000):
        cut = list(pieces.pieces(raw, re.compile(rb" "), step))
        assert b"".join(cut) == raw
        assert [w for p in cut for w in p.split()] == raw.split()


def test_features_by_piece(monkeypatch):
    text = " ".join(f"W{i % 13}é" for i in range(200)) + " A-b"
    whole = [tuple(b) for _, b in resampling.feature_buckets(text, 3)]
    monkeypatch.setattr(resampling, "pieces", lambda raw, gap: pieces.pieces(raw, gap, 9))
    parts = [tuple(b) for _, b in resampling.feature_buckets(text, 3)]
    assert len(parts) > 10 and sorted(sum(parts, ())) == sorted(sum(whole, ()))


# --- language identification -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tongues(spark, sf_dir):
    return language.fit(common.read(spark, sf_dir, "documents"))


def test_language_on_held_out_rows(spark):
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs)
    rows = language.identified(docs, model).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 250
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.99
    assert np.mean([r.lang_pred == r.lang for r in held if r.n_chars < 200]) >= 0.95


def test_language_ignores_labels_of_held_out_rows(spark, sf_dir, tongues):
    docs = common.read(spark, sf_dir, "documents")
    lied = docs.withColumn("lang", F.when(language.in_fold(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    model = language.fit(lied.withColumn("source", F.lit("other")))
    assert model.languages == tongues.languages
    assert np.array_equal(model.coefficients, tongues.coefficients)


def test_language_edge_cases(spark, docs, no_docs, tongues):
    got = language.identified(docs, tongues).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = {i: t for i, t, _ in ROWS}[r.doc_id] or ""
        assert (r.lang_pred == "und" and r.score == 0) == (not any(c.isalpha() for c in text))
    assert language.identified(no_docs, tongues).collect() == []
    unlearnt = language.fit(no_docs)
    assert unlearnt.languages == []
    assert {r.lang_pred for r in language.identified(docs, unlearnt).collect()} == {"und"}
    one = language.fit(docs)
    assert one.languages == ["en"]
    odd = spark.createDataFrame([(None, "the words of it"), (3, "12 %% 34"), (4, "İ" * 3000)], "doc_id long, text string")
    found = {r.doc_id: r for r in language.identified(odd, tongues).collect()}
    assert not found[None].held_out and found[None].lang_pred == "en" and found[3].lang_pred == "und" and found[4].score >= 0


def test_language_does_not_depend_on_neighbours(tongues):
    texts = ["the words of this and that", "", "être de la même", "12", "und der die das " * 400]
    letter = language.letters()
    together, _ = language.scores(texts, tongues, letter)
    alone = np.concatenate([language.scores([t], tongues, letter)[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6)


def test_presence_is_that_of_plain_ngrams():
    letter = language.letters()
    texts = ["Ab a1b", "ab", "", "ß-ß ab"]
    found, n_letters = language.presence(texts, letter)
    assert n_letters.tolist() == [4, 2, 0, 4]

    def plain(t):
        t = "  " + "".join(c if c.isalpha() else " " for c in t.lower()) + "  "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(2, len(t) - n + 1) if t[i : i + n].strip()} | {
            t[i : i + n] for n in (1, 2, 3) for i in range(3 - n, 2) if t[i : i + n].strip()
        }

    shared = found @ found.T
    want = [[len(plain(a) & plain(b)) for b in texts] for a in texts]
    assert shared.astype(int).tolist() == want


# --- filter audit ------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """rows of (doc_id, lang, text), labels of (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    smallest = {}
    for d, _, t in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    found = {}
    for d, lang, t in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > smallest[t],
        }
        found.setdefault(lang or "", []).append(({f for f, v in fails.items() if v}, d in good, d in toxic))
    out = []
    for part, docs in found.items():
        share = Counter()
        mine = []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                share[f] += len(removed)
                failing = sum(f in x[0] for x in docs)
                only = sum(x[0] == {f} for x in docs)
                mine.append((f, (part, "".join(order), step, len(left), len(removed), failing - len(removed), only, sum(x[1] for x in removed), sum(x[2] for x in removed))))
        out += [(*row, share[f]) for f, row in mine]
    return sorted(out)


LABELS = [(1, 1, 0), (4, 0, 1), (5, 1, 1), (5, 0, 0), (6, 1, None), (13, None, 1), (20, 1, 0), (None, 1, 1), (99, 1, 1)]


def test_audit_equals_plain_filters(spark, no_docs):
    rows = [
        *[(i, [None, "en", "", "fr"][i % 4], t) for i, t, _ in ROWS],
        *[(100 + i, "fr", "copies of it " * 80) for i in range(50)],
        *[(None, "en", "copies of it " * 80)] * 20,
        *[(200, "en", "one id, one text")] * 5,
        (200, "en", "one id, another text " + " ".join(f"w{i}" for i in range(300))),
        (300, "fr", " ".join(f"W{i}" for i in range(300)) + " #"),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, lang string, text string, part int, digest string")
    labels = spark.createDataFrame([(*r, 1) for r in LABELS], "doc_id long, quality int, toxic int, n int")
    got = filter_audit.audited(docs.repartition(5), labels)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, LABELS)
    assert filter_audit.audited(no_docs, labels).collect() == []
    unlabelled = filter_audit.audited(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(unlabelled) == (0, 0)


def test_audit_counts_conditions_by_piece(monkeypatch):
    text = " ".join(f"w{i % 90}" for i in range(210)) + " A&"
    whole = filter_audit.text_fails(text)
    monkeypatch.setattr(filter_audit, "pieces", lambda raw, gap: pieces.pieces(raw, gap, 11))
    assert filter_audit.text_fails(text) == whole == 0b1010
