import os
import threading

import pytest
from pyspark.sql import functions as F

from recordmill.plans.core import rejected_values
from recordmill.sources import ingest as ingest_module
from recordmill.sources import splits
from recordmill.sources.ingest import fingerprint, ingest, ingest_all, manifest
from recordmill.sources.specs import EMPTY_MARKER, NO_TEACHER, SPECS, SourceSpec
from recordmill.sources.store import Store
from recordmill.streaming.incremental import first_of_each, ingest_stream, keep_new_events


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


STUDENT_HEAD = ";".join(SPECS["students"].columns)
INTERNAL_HEAD = ",".join(SPECS["internal_activities"].columns)
PUB_HEAD = list(SPECS["publications"].columns)


@pytest.fixture()
def tree(tmp_path):
    root = str(tmp_path / "in put")
    c = f"{root}/cicli"
    write(
        f"{c}/35/0_students_info.csv",
        STUDENT_HEAD + "\n"
        "1;D1;A@X.IT;Rossi;Mario;35;T;;ok;12,5;10;1;2;0;3\n"
        "2;NA;b@x.it;Verdi;None;35;T;;ok;-;abc;1;2;0;3\n"
        "3;;c@x.it;Bianchi\n"
        "4;D4;;\"Neri\nGialli\";Ugo;35;T;;ok;1;1;1;1;1;1\n"
        "5;D5;;A;B;35;T;;ok;1;1;1;1;1;1;EXTRA\n",
    )
    # Other order, one extra and one missing column.
    write(f"{c}/36/0_students_info.csv", "Nome;Cognome;Matricola dottorando/a:;Extra\nMario;Rossi;1;x\nLia;Viola;9;y\n")
    body = "A1,Course A,20,20,-,1,3/4/2024,Hard,L,C,\"1,5\"\n"
    write(f"{c}/35/1_attivita_formative_interne.csv", INTERNAL_HEAD + "\n" + body)
    write(f"{c}/35/2_attivita_formative_interne.csv", INTERNAL_HEAD + "\n" + body)
    write(f"{c}/35/3_attivita_formative_interne.csv", f"x\n{EMPTY_MARKER.upper()}\n")
    write(f"{c}/35/4_attivita_formative_interne.csv", INTERNAL_HEAD + "\n")
    pub = ["2024", "Journal", "Title one", "R", "Rossi, Mario; Bianchi, Anna;", "", "si", "50", "1", "50", "1,5", "0"]
    null_author = [*pub[:2], "Title two", "R", "", *pub[5:]]
    write(f"{c}/35/1_pubblicazioni.csv", "\t".join(PUB_HEAD) + "\n" + "\t".join(pub) + "\n" + "\t".join(null_author) + "\n")
    write(f"{c}/35/2_pubblicazioni.csv", "\t".join(h for h in PUB_HEAD if h != "Autori") + "\n" + "\t".join(pub[:11]) + "\n")
    write(f"{root}/corsi/01ABC_2023.csv", "matricola\tcognome\tnome\tcodInsegnamento\tcodCorsoDottorato\tPeriodoDidattico\t-\tstato\n1\tRossi\tMario\t01ABC\tX\t1\t-\tok\n")
    write(
        f"{root}/corsi/dettaglio_corso_01ABC_2023.csv",
        "Type\tTeacher\tStatus\tSSD\th.Les\th.Ex\th.Lab\th.Tut\tYears teaching\n"
        f"a\tDoc One\ts\tI\t10\t1,5\t\t\t3\nb\t{NO_TEACHER}\ts\tI\t1\t1\t1\t1\t1\nc\t\ts\tI\t2\t2\t2\t2\t2\n",
    )
    write(f"{root}/collaborazioni_dettaglio.csv", "Matricola Dott,Cognome\n1,Rossi\n")
    return root


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def events(store):
    return {
        (r.source, r.file_name): (r.status, r.rows_loaded, r.error_message)
        for r in store.read_log("file_manifest").collect()
    }


def test_tree_loads_once_and_by_header_name(spark, tree, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    specs = [SPECS[n] for n in ("students", "internal_activities", "publications", "enrolments", "course_details", "collaborations", "mobility")]
    run = ingest_all(spark, specs, tree, store)
    seen = events(store)
    assert {r.status for r in store.read_log("file_manifest").where("source = 'students'").collect()} == {"LOADED"}
    assert seen[("internal_activities", "3_attivita_formative_interne.csv")] == ("SKIPPED", 0, "Empty marker detected")
    assert seen[("internal_activities", "4_attivita_formative_interne.csv")] == ("SKIPPED", 0, "No rows after transform")
    assert seen[("internal_activities", "1_attivita_formative_interne.csv")] == ("LOADED", 1, None)
    # Equal bytes of two students: both load, because the key comes from the path.
    assert seen[("internal_activities", "2_attivita_formative_interne.csv")] == ("LOADED", 1, None)
    assert seen[("publications", "2_pubblicazioni.csv")][0] == "FAILED"
    assert seen[("collaborations", "collaborazioni_dettaglio.csv")][0] == "FAILED"
    assert "Tutor" in seen[("collaborations", "collaborazioni_dettaglio.csv")][2]
    assert ("enrolments", "dettaglio_corso_01ABC_2023.csv") not in seen

    students = store.read("staging", "students")
    assert students.columns == SPECS["students"].staged_columns
    assert rows(students, "matricola_dottorando", "cognome", "nome", "matricola_dipendente_docente") == sorted(
        [("1", "Rossi", "Mario", "D1"), ("2", "Verdi", None, None), ("3", "Bianchi", None, None),
         ("4", "Neri\nGialli", "Ugo", "D4"), ("1", "Rossi", "Mario", None), ("9", "Viola", "Lia", None)], key=str)
    assert {os.path.dirname(r[0])[-2:] for r in rows(students, "source_file")} == {"35", "36"}
    bad = store.read("quarantine", "students").collect()
    assert len(bad) == 1 and bad[0].raw_line.endswith("EXTRA") and bad[0].reasons == ["row longer than header"]

    assert rows(store.read("staging", "attivita_formative_interne"), "matricola", "ciclo", "punti") == [
        ("1", "35", "1,5"), ("2", "35", "1,5")]
    assert rows(store.read("staging", "pubblicazioni"), "titolo", "autori") == [
        ("Title one", ""), ("Title one", "Bianchi, Anna"), ("Title one", "Rossi, Mario"), ("Title two", None)]
    assert rows(store.read("staging", "corsi"), "cod_ins", "anno", "matricola") == [("01ABC", "2023", "1")]
    assert rows(store.read("staging", "dettaglio_corso"), "teacher", "cod_ins") == [("Doc One", "01ABC"), (None, "01ABC")]

    summary = store.runs().collect()
    assert summary[0].run_id == run and summary[0].status == "FAILED"
    assert {r.step_name: r.rows_out for r in store.read_log("step_metrics").collect()}["ingest.publications"] == 4

    # Again: nothing new but the failed files, which are tried again.
    before = {t: store.read("staging", t).count() for t in ("students", "pubblicazioni", "corsi")}
    n_events = store.read_log("file_manifest").count()
    ingest_all(spark, specs, tree, store)
    assert {t: store.read("staging", t).count() for t in before} == before
    assert store.read_log("file_manifest").count() == n_events + 2

    # A repaired file loads on the next run.
    head = ",".join(SPECS["collaborations"].columns)
    write(f"{tree}/collaborazioni_dettaglio.csv", head + "\n1,Rossi,Mario,35,T,10,a,m,d,lm\n")
    ingest_all(spark, [SPECS["collaborations"]], tree, store)
    assert store.read("staging", "collaborazioni_dettaglio").count() == 1



def test_global_scope_loads_equal_bytes_once(spark, tree, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    got = ingest(spark, SPECS["internal_activities"], tree, store, "r", scope="global")
    loaded = [r.file_name for r in got.collect() if r.status == "LOADED"]
    assert loaded == ["1_attivita_formative_interne.csv"]
    assert manifest(store, "global").count() == 3


def test_hash_keeps_the_order_of_lines_and_not_the_splits(spark, tmp_path):
    root = str(tmp_path)
    lines = [f"{i};value {i % 7}" for i in range(5000)]
    write(f"{root}/a.csv", "x;y\n" + "\n".join(lines) + "\n")
    lines[10], lines[4000] = lines[4000], lines[10]
    write(f"{root}/b.csv", "x;y\n" + "\n".join(lines) + "\n")
    spec = SourceSpec("any", "any", "*.csv", ";", {"x": "x", "y": "y"})
    facts = {r.file_name: r for r in fingerprint(spark, spec, f"{root}/*.csv").collect()}
    assert facts["a.csv"].header == "x;y"
    assert len({r.file_hash_sha256 for r in facts.values()}) == 2
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        split = {r.file_name: r.file_hash_sha256 for r in fingerprint(spark, spec, f"{root}/*.csv").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert split == {n: r.file_hash_sha256 for n, r in facts.items()}
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, spec, root, store, "r")
    assert store.read("staging", "any").count() == 10_000


def test_settled_files_are_not_read_again(spark, tree, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, SPECS["students"], tree, store, "r")
    monkeypatch.setattr("recordmill.sources.ingest.fingerprint", lambda *_: pytest.fail("a settled file was read"))
    assert ingest(spark, SPECS["students"], tree, store, "s").count() == 0
    assert store.read("staging", "students").count() == 6


@pytest.mark.parametrize("log", ["commits", "file_manifest"])
def test_a_run_that_dies_between_two_writes_loads_nothing_twice(spark, tree, tmp_path, monkeypatch, log):
    store = Store(spark, str(tmp_path / "store"))
    write_log = Store.append_log

    def dying(self, name, rows):
        if name == log:
            raise KeyboardInterrupt
        write_log(self, name, rows)

    monkeypatch.setattr(Store, "append_log", dying)
    with pytest.raises(KeyboardInterrupt):
        ingest(spark, SPECS["students"], tree, store, "r")
    monkeypatch.setattr(Store, "append_log", write_log)
    assert store.read("staging", "students") is None
    ingest(spark, SPECS["students"], tree, store, "s")
    assert store.read("staging", "students").count() == 6
    assert store.read("quarantine", "students").count() == 1


def test_a_failed_file_of_a_stream_is_tried_again(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/a.csv", "y\n1\n")
    spec = SourceSpec("any", "any", "*.csv", ",", {"x": "x", "y": "y"}, strict=True)
    store = Store(spark, str(tmp_path / "store"))
    ingest_stream(spark, spec, root, store, "r", str(tmp_path / "checkpoint"))
    assert store.read("staging", "any") is None
    write(f"{root}/a.csv", "x,y\n5,6\n")
    ingest_stream(spark, spec, root, store, "s", str(tmp_path / "checkpoint"))
    assert rows(store.read("staging", "any"), "x", "y") == [("5", "6")]


def test_delimiter_is_found_per_file(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/a.csv", "x;y\n1;2\n")
    write(f"{root}/b.csv", "y\tx\n4\t3\n")
    write(f"{root}/c.csv", '"x;y",\n"5;6",\n')
    write(f"{root}/d.csv", "x,y\n7,8\n")
    spec = SourceSpec("any", "any", "*.csv", None, {"x": "x", "y": "y"})
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, spec, root, store, "r")
    assert rows(store.read("staging", "any"), "x", "y") == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8")]


def test_rejected_values_name_the_columns(spark, tree, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    ingest(spark, SPECS["students"], tree, store, "r")
    bad = rejected_values(store.read("staging", "students"), "students").collect()
    assert [(r.matricola_dottorando, r.reasons) for r in bad] == [("2", ["ore_soft_skills", "ore_hard_skills"])]


def test_upsert_and_insert_absent(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.upsert("core", "t", first, ["k"])
    store.upsert("core", "t", spark.createDataFrame([(2, "c"), (3, "e"), (3, "d")], "k int, v string"), ["k"], ["v"])
    assert rows(store.read("core", "t"), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    store.insert_absent("core", "t", spark.createDataFrame([(3, "x"), (4, "z"), (4, "y")], "k int, v string"), "k", ["v"])
    assert rows(store.read("core", "t"), "k", "v") == [(1, "a"), (2, "c"), (3, "d"), (4, "y")]
    assert store.read("core", "none", "k int").count() == 0


def test_upsert_writes_only_the_buckets_it_meets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.upsert("core", "t", spark.range(1000).selectExpr("id as k", "'old' as v"), ["k"], buckets=50)
    before = set(store._parts("core", "t"))
    assert len(before) == 50
    store.upsert("core", "t", spark.createDataFrame([(3, "new"), (1003, "new")], "k long, v string"), ["k"], buckets=50)
    after = set(store._parts("core", "t"))
    assert len(after) == 50 and 48 <= len(before & after) <= 49
    want = sorted([(k, "new" if k in (3, 1003) else "old") for k in (*range(1000), 1003)], key=str)
    assert rows(store.read("core", "t"), "k", "v") == want
    # nothing new, another column, an append, another number of buckets
    store.upsert("core", "t", spark.createDataFrame([], "k long, v string"), ["k"], buckets=50)
    assert set(store._parts("core", "t")) == after
    store.upsert("core", "t", spark.createDataFrame([(3, "newer", 1)], "k long, v string, n int"), ["k"], buckets=50)
    assert rows(store.read("core", "t").where("k in (3, 4)"), "k", "v", "n") == [(3, "newer", 1), (4, "old", None)]
    store.append("core", "t", spark.createDataFrame([(5000, "more", 2)], "k long, v string, n int"))
    store.upsert("core", "t", spark.createDataFrame([(5000, "most", 3)], "k long, v string, n int"), ["k"], buckets=7)
    assert len(store._parts("core", "t")) == 7
    assert store.read("core", "t").count() == 1002
    assert rows(store.read("core", "t").where("k = 5000"), "k", "v", "n") == [(5000, "most", 3)]


def test_upsert_into_empty_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.upsert("core", "t", spark.createDataFrame([], "k int, v string"), ["k"])
    assert store.read("core", "t").columns == ["k", "v"] and store.read("core", "t").count() == 0
    for k in range(4):
        store.upsert("core", "t", spark.createDataFrame([(k, "a")], "k int, v string"), ["k"])
    assert rows(store.read("core", "t"), "k", "v") == [(k, "a") for k in range(4)]


def test_reads_of_few_files_load_them_all(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/a.csv", "y\n1\n")
    write(f"{root}/b.csv", "x,y\n1,2\n")
    write(f"{root}/c.csv", "x,y\n3,4\n")
    spec = SourceSpec("any", "any", "*.csv", ",", {"x": "x", "y": "y"}, strict=True)
    store = Store(spark, str(tmp_path / "store"))
    ingest_all(spark, [spec], root, store, files_per_read=1)
    assert rows(store.read("staging", "any"), "x", "y") == [("1", "2"), ("3", "4")]
    assert sorted(r.status for r in store.read_log("file_manifest").collect()) == ["FAILED", "LOADED", "LOADED"]


def arriving(spark, root, number, rows):
    spark.createDataFrame(rows, "k string, v int, w string").coalesce(1).write.mode("append").parquet(f"{root}/{number:03}")
    return spark.readStream.schema("k string, v int, w string").option("maxFilesPerTrigger", 1).parquet(f"{root}/*")


@pytest.mark.parametrize("order", [(), ("v",)])
def test_keys_of_a_stream_are_kept_in_its_state(spark, tmp_path, monkeypatch, order):
    store, root, checkpoint = Store(spark, str(tmp_path / "store")), str(tmp_path / "in"), str(tmp_path / "cp")
    monkeypatch.setattr(Store, "insert_absent", lambda *_: pytest.fail("stored keys were read"))
    seen = {}
    for number in range(5):
        rows = [(f"k{(number * 3 + i) % 11}" if i else None, i, "b") for i in range(6)] + [(f"k{number}", -1 - number, None)]
        for k, v, w in sorted(rows, key=lambda r: r[1]):
            seen.setdefault((number, k), (v, w))
        keep_new_events(arriving(spark, root, number, rows), store, "staging", "t", ["k"], checkpoint, order)
    want = {}
    for (_, k), row in seen.items():
        want.setdefault(k, row)
    got = [(r.k, (r.v, r.w)) for r in store.read("staging", "t").collect()]
    assert sorted((k or "") for k, _ in got) == sorted((k or "") for k in want)
    if order:
        assert dict(got) == want


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path, monkeypatch):
    store, root, checkpoint = Store(spark, str(tmp_path / "store")), str(tmp_path / "in"), str(tmp_path / "cp")
    stream = arriving(spark, root, 0, [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")])
    append = Store.append

    def then_dying(self, *args):
        append(self, *args)
        raise RuntimeError("after the commit")

    monkeypatch.setattr(Store, "append", then_dying)
    with pytest.raises(Exception):
        keep_new_events(stream, store, "staging", "t", ["k"], checkpoint)
    monkeypatch.setattr(Store, "append", append)
    keep_new_events(arriving(spark, root, 1, [("c", 1, "x"), ("a", 9, "x")]), store, "staging", "t", ["k"], checkpoint)
    assert sorted(r.k for r in store.read("staging", "t").collect()) == ["a", "b", "c"]


def test_the_state_does_not_read_stored_rows(spark, tmp_path):
    """Every batch reads its own file only, whatever is stored."""
    root, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for number in range(8):
        stream = arriving(spark, root, number, [(f"{number}-{i}", i, "x") for i in range(50)])
    read = []
    query = first_of_each(stream, ["k"]).writeStream.foreachBatch(lambda df, i: read.append(df.count()))
    query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert read == [50] * 8 and [p["numInputRows"] for p in batches] == [50] * 8
    assert [p["stateOperators"][0]["numRowsTotal"] for p in batches] == [50 * (i + 1) for i in range(8)]


def test_the_first_line_comes_with_the_digest(spark, tmp_path):
    for name, text in {"a": "h;è\nx\n", "b": "only", "c": "\nsecond\n", "d": 'h\r\n"q\n"\n'}.items():
        write(f"{tmp_path}/f+ %/{name}.csv", text)
    files = str(tmp_path / "f+ %" / "*.csv")
    facts = {r.file_path.rsplit("/", 1)[1][0]: r for r in fingerprint(spark, SPECS["students"], files).collect()}
    assert {k: r.header for k, r in facts.items()} == {"a": "h;è", "b": "only", "c": "", "d": "h"}
    assert {k: r.multiline for k, r in facts.items()} == {"a": False, "b": False, "c": False, "d": True}
    assert all(r.file_path.startswith(f"{tmp_path}/f+ %/") for r in facts.values())
    # no line is sorted to find the first one
    per_split = splits.lines_of(spark, files).groupBy("file_path", "block").agg(F.count("*").alias("n_bytes"))
    assert "line" in splits.digests(spark, files, per_split).columns


def test_groups_of_a_read_are_loaded_at_the_same_time(spark, tmp_path, monkeypatch):
    write(f"{tmp_path}/in/a.csv", "Key;Name\n1;a\n")
    write(f"{tmp_path}/in/b.csv", "Name;Key\nb;2\n")
    together, read = threading.Barrier(2, timeout=60), ingest_module.read_group

    def meeting(*args):
        together.wait()
        return read(*args)

    monkeypatch.setattr(ingest_module, "read_group", meeting)
    store = Store(spark, str(tmp_path / "store"))
    spec = SourceSpec("pairs", "pairs", "*.csv", ";", {"Key": "key", "Name": "name"})
    assert {e.status for e in ingest(spark, spec, str(tmp_path / "in"), store, "r").collect()} == {"LOADED"}
    assert sorted(map(tuple, store.read("staging", "pairs").select("key", "name").collect())) == [("1", "a"), ("2", "b")]
