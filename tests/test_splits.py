"""Digests and quoted rows of files that many tasks read, against plain readers of the whole file."""

import csv
import hashlib
import io
import random

import pytest

from recordmill.sources import splits
from recordmill.sources.ingest import fingerprint, ingest
from recordmill.sources.specs import SourceSpec
from recordmill.sources.store import Store

SPEC = SourceSpec("any", "any", "*.csv", ";", {"a": "a", "b": "b", "c": "c"}, null_tokens=())


@pytest.fixture()
def small_splits(spark):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def text_of(seed, n=400):
    """Rows with breaks, delimiters and quotes inside quotes, and quotes inside plain fields."""
    r = random.Random(seed)
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator="\n")
    w.writerow(["a", "b", "c"])
    for i in range(n):
        long = "\n".join("line %d of \"it\"; with more" % j for j in range(r.choice([1, 2, 3, 40])))
        w.writerow([f"{i}", r.choice(["plain", "with \"quotes\"", "a\nb", "", "x;y", long, '"\n"', "\n\n"]), f"end {i % 7}"])
    return out.getvalue()


def put(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("size", [300, 1 << 27])
def test_quoted_rows_do_not_depend_on_splits(spark, tmp_path, small_splits, size):
    want = []
    for seed in range(3):
        text = text_of(seed, 30)
        put(f"{tmp_path}/f {seed}.csv", text if seed else text.rstrip("\n"))
        want += [tuple(x or None for x in row) for row in list(csv.reader(io.StringIO(text), delimiter=";"))[1:]]
    small_splits(size)
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, SPEC, str(tmp_path), store, "r")
    got = [tuple(r) for r in store.read("staging", "any").select("a", "b", "c").collect()]
    # written without quotes, an empty text is no value
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quotes_in_plain_fields_open_nothing(spark, tmp_path, small_splits):
    put(f"{tmp_path}/x.csv", 'a;b;c\n1;5" disk;x\n2;"two\nlines";y\n3;ab"c"d;"e"\n4;3" and 4";"open\nclosed"\n\n5;;\r\n')
    small_splits(40)
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, SPEC, str(tmp_path), store, "r")
    got = sorted(tuple(r) for r in store.read("staging", "any").select("a", "b", "c").collect())
    assert got == [
        ("1", '5" disk', "x"), ("2", "two\nlines", "y"), ("3", 'ab"c"d', "e"), ("4", '3" and 4"', "open\nclosed"), ("5", None, None),
    ]


def test_one_large_file_is_cut_by_many_tasks(spark, tmp_path, small_splits):
    text = text_of(9, 600)
    put(f"{tmp_path}/x.csv", text)
    small_splits(1024)
    lines = splits.lines_of(spark, [f"{tmp_path}/x.csv"])
    assert lines.rdd.getNumPartitions() > 20
    rows = splits.quoted_rows(spark, [f"{tmp_path}/x.csv"], ";")
    assert rows.count() == len(list(csv.reader(io.StringIO(text), delimiter=";"))) - 1


def plain_state(data, sep):
    """State of quoting after each line, by one character after the other over the whole text."""
    inside, at_start, plain, out, i = False, True, False, [], 0
    while i < len(data):
        c = data[i : i + 1]
        if inside:
            if c == b'"':
                if data[i + 1 : i + 2] == b'"':
                    i += 1
                else:
                    inside, plain = False, True
            elif c == b"\n":
                out.append(True)
        elif c == b"\n":
            out.append(False)
            at_start, plain = True, False
        elif c == sep:
            at_start, plain = True, False
        elif at_start and c == b'"':
            inside, at_start = True, False
        else:
            at_start = False
        i += 1
    return out


def test_state_of_quoting_equals_a_walk_over_characters():
    r = random.Random(3)
    for _ in range(3000):
        data = bytes(r.choice(b'"";;\nab"') for _ in range(r.randint(1, 30))) + b"\n"
        inside, got = False, []
        for line in data.split(b"\n")[:-1]:
            inside = splits.inside_after(line, inside, b";")
            got.append(inside)
        assert got == plain_state(data, b";"), data


def test_states_are_the_prefix_of_what_splits_do(spark):
    r = random.Random(1)
    rows, want = [], {}
    for file in range(20):
        state = False
        for block in range(r.randint(1, 12)):
            effect = r.choice([(False, False), (True, True), (False, True), (True, False)])
            rows.append((file, block * 10, *effect))
            want[file, block * 10] = state
            state = effect[1] if state else effect[0]
    df = spark.createDataFrame(rows, "file int, block long, from_outside boolean, from_inside boolean").repartition(4)
    assert {(x.file, x.block): x.inside for x in splits.states(df).collect()} == want


def hashes(spark, tmp_path):
    return {r.file_name: r.file_hash_sha256 for r in fingerprint(spark, SPEC, f"{tmp_path}/*.csv").collect()}


def test_digest_is_a_tree_over_fixed_blocks(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(splits, "LEAF", 1000)
    monkeypatch.setattr(splits, "FAN", 3)
    texts = {
        "a.csv": text_of(1).encode(), "b.csv": b"one line", "c.csv": b"x\n", "d.csv": b"y" * 25_000 + b"\nz\r\n", "e.csv": b"\n" * 999,
        "f.csv": b"\xff\xfe\x00 not a text\n", "g.csv": b"k" * 999 + b"\n",
    }
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    want = {n: hashlib.sha256(f"{len(d)}:{splits.tree_of(d)}".encode()).hexdigest() for n, d in texts.items()}
    for size in (3001, 1 << 27):
        small_splits(size)
        assert hashes(spark, tmp_path) == want


def test_digest_sees_one_byte_and_the_order(spark, tmp_path, small_splits):
    data = text_of(2, 600).encode()
    other = bytearray(data)
    other[len(data) // 2] ^= 1
    lines = data.split(b"\n")
    lines[5], lines[400] = lines[400], lines[5]
    for name, d in {"a": data, "b": bytes(other), "c": b"\n".join(lines), "d": data[:-1], "e": data}.items():
        (tmp_path / f"{name}.csv").write_bytes(d)
    small_splits(4000)
    found = hashes(spark, tmp_path)
    assert found["a.csv"] == found["e.csv"] and len(set(found.values())) == 4
