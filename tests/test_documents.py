import random
import re

from pyspark.sql import functions as F

from recordmill.operators import documents as docs

DATE = re.compile(docs.DATE_LINE.replace(r"\z", r"\Z"))


def plain_records(lines):
    """The rule, stated by positions: title, company, first date line from the third on, location."""
    out, at = [], 0
    while at < len(lines):
        if lines[at] in docs.NOISE_LINES:
            at += 1
            continue
        dates = [k for k in range(at + 2, len(lines)) if DATE.match(lines[k])]
        if not dates:
            break
        d = dates[0]
        out.append((lines[at], lines[at + 1], lines[d], lines[d + 1] if d + 1 < len(lines) else None))
        at = d + 2
    return out


def plain_section(lines):
    if docs.START_MARKER not in lines:
        return []
    rest = lines[lines.index(docs.START_MARKER) + 1 :]
    stops = [i for i, x in enumerate(rest) if x in docs.END_MARKERS]
    return rest[: stops[0]] if stops else rest


def frame(spark, documents):
    rows = [(str(i), f"Ann Doe _{i}.pdf", pages, error) for i, (pages, error) in enumerate(documents)]
    return spark.createDataFrame(rows, "document_id string, source_file string, pages array<string>, error string")


def test_records_match_the_rule_on_random_documents(spark):
    rnd = random.Random(3)
    words = ["Engineer", "Acme · Full-time", "Acme · A · B", "Jan 2020 - Present · 3 yrs", "Feb 2019 - Dec 2020 · 1 yr",
             "Feb 2019 - Dec 2020", "Torino", "Show all", "Experience", "Education", "text"]
    documents = []
    for _ in range(300):
        lines = [rnd.choice(words) for _ in range(rnd.randrange(0, 40))]
        if rnd.random() < 0.7:
            lines.insert(rnd.randrange(0, len(lines) + 1), "Experience")
        cut = rnd.randrange(0, len(lines) + 1)
        documents.append((["\n".join(lines[:cut]), " \r\n" + "\n\n".join(f"  {x} " for x in lines[cut:])], None))
    df = frame(spark, documents)
    got = {r.document_id: [tuple(x) for x in r.records] for r in docs.parsed(df).collect()}
    for i, (pages, _) in enumerate(documents):
        lines = [x.strip() for p in pages for x in p.splitlines() if x.strip()]
        assert got[str(i)] == plain_records(plain_section(lines)), lines


def test_roles_and_status(spark):
    one = "x\nExperience\nPhD Student\nPoli · Full-time · x\nnoise\nNov 2023 - Present · 1 yr\nTorino\nEducation\nA\nB\nJan 2020 - Present · y"
    df = frame(spark, [([one], None), (["nothing"], None), (None, "broken file"), (["Experience\nDev", "Acme\nJan 2020 - Feb 2021 · 1"], None)])
    parsed = docs.parsed(df)
    roles = sorted(tuple(r) for r in docs.role_rows(parsed).drop("source_file").collect())
    assert roles == [
        ("0", 1, "PhD Student", "Poli", "Full-time · x", "Nov 2023 - Present · 1 yr", "Torino"),
        ("3", 1, "Dev", "Acme", None, "Jan 2020 - Feb 2021 · 1", None),
    ]
    status = {r.document_id: (r.status, r.error_message) for r in docs.document_status(parsed).collect()}
    assert status == {
        "0": ("PARSED", None), "1": ("NEEDS_REVIEW", docs.NO_RECORDS), "2": ("FAILED", "broken file"), "3": ("PARSED", None)}
    pages = [(r.document_id, r.page_number) for r in docs.page_rows(df).orderBy("document_id", "page_number").collect()]
    assert pages == [("0", 1), ("1", 1), ("3", 1), ("3", 2)]


def test_section_of_rows_equals_section_of_array(spark):
    rnd = random.Random(5)
    rows = [(k, i, rnd.choice(["Experience", "Skills", "a", "b"])) for k in range(40) for i in range(rnd.randrange(1, 15))]
    df = spark.createDataFrame(rows, "k int, i int, line string")
    got = docs.section_rows(df, "k", "i", F.col("line") == "Experience", F.col("line") == "Skills")
    found = {}
    for r in got.orderBy("k", "i").collect():
        found.setdefault(r.k, []).append(r.line)
    for k in range(40):
        assert found.get(k, []) == plain_section([x for kk, _, x in rows if kk == k])
