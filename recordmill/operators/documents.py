"""Documents: pages to lines, the section between two markers, records, status.

A document is one row with its pages as an array, the way text extraction delivers a
file, so everything up to the records is a narrow transformation of that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed texts of the profile layout.
START_MARKER = "Experience"
END_MARKERS = ("Education", "Licenses & certifications", "Skills")
NOISE_LINES = ("Show all posts", "Show all")
_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
DATE_LINE = rf"^{_MONTH}\s+\d{{4}}\s*-\s*(?:Present|{_MONTH}\s+\d{{4}})\s*·\s*.+\z"
NO_RECORDS = "No roles parsed from Experience section"

RECORD = "struct<title:string,company_line:string,dates:string,location:string>"
_STATE = f"struct<phase:int,title:string,company_line:string,dates:string,records:array<{RECORD}>>"


def document_id(content: Column) -> Column:
    """The id of a document is the hash of its content, so copies share it."""
    return F.sha2(content, 256)


def registered(documents: DataFrame, content: Column, order: Sequence[str]) -> DataFrame:
    """One row per distinct content: the first in ``order``."""
    from recordmill.operators.dedup import keep_first

    keyed = documents.withColumn("document_id", document_id(content))
    return keep_first(keyed, ["document_id"], [F.col(c).asc_nulls_last() for c in order])


def page_rows(documents: DataFrame) -> DataFrame:
    """(document_id, source_file, page_number, text), pages counted from 1."""
    return documents.select("document_id", "source_file", F.posexplode("pages").alias("n", "text")).select(
        "document_id", "source_file", (F.col("n") + 1).alias("page_number"), "text"
    )


def text_lines(text: Column) -> Column:
    """Trimmed non-empty lines, in order."""
    trimmed = F.transform(F.split(text, r"\R"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+\z", ""))
    return F.filter(trimmed, lambda x: x != "")


def document_lines(pages: Column) -> Column:
    """Lines of all pages; a page without text has none."""
    return F.flatten(F.transform(pages, lambda p: F.coalesce(text_lines(p), F.array().cast("array<string>"))))


def line_rows(documents: DataFrame) -> DataFrame:
    """(document_id, line_number, line), lines counted from 1."""
    lines = _exploded(documents.withColumn("__lines", document_lines(F.col("pages"))), "__lines", "line")
    return lines.select("document_id", (F.col("n") + 1).alias("line_number"), "line")


def _exploded(documents: DataFrame, array: str, item: str) -> DataFrame:
    """Items with their position ``n``.

    The outer form keeps the planner from adding a "not empty" filter, which would be
    pushed to the scan and make the array a second time there.
    """
    rows = documents.select("document_id", "source_file", F.posexplode_outer(array).alias("n", item))
    return rows.where(F.col("n").isNotNull())


def _first_of(lines: Column, values: Sequence[str]) -> Column:
    return F.array_position(F.transform(lines, lambda x: x.isin(*values)), True).cast("int")


def _up_to(lines: Column, stop: Column) -> Column:
    return F.when(stop > 0, F.slice(lines, F.lit(1), stop - 1)).otherwise(lines)


def section_rows(
    rows: DataFrame, key: str, position: str, is_start: Column, is_end: Column
) -> DataFrame:
    """The same cut for items stored one per row.

    The bounds of a key come from two aggregates; no group is ever put together, so a
    key with very many items is cut as cheaply as many small ones.
    """
    starts = rows.where(is_start).groupBy(key).agg(F.min(position).alias("__start"))
    after = rows.join(starts, key).where(F.col(position) > F.col("__start"))
    ends = after.where(is_end).groupBy(key).agg(F.min(position).alias("__end"))
    return (
        after.join(ends, key, "left")
        .where(F.col("__end").isNull() | (F.col(position) < F.col("__end")))
        .select(*rows.columns)
    )


def records(lines: Column) -> Column:
    """Role records of a section: title, company, anything up to a date line, location.

    One pass over the lines. Phases: 0 wants a title, 1 a company, 2 a date line,
    3 a location.
    """

    def state(phase, title, company, dates, done) -> Column:
        return F.struct(
            F.lit(phase).alias("phase"), title.alias("title"), company.alias("company_line"),
            dates.alias("dates"), done.alias("records"),
        )

    def record(s: Column, location: Column) -> Column:
        return F.array(F.struct(s.title, s.company_line, s.dates, location.alias("location")).cast(RECORD))

    nothing = F.lit(None).cast("string")

    def step(s: Column, line: Column) -> Column:
        return (
            F.when((s.phase == 0) & line.isin(*NOISE_LINES), s)
            .when(s.phase == 0, state(1, line, nothing, nothing, s.records))
            .when(s.phase == 1, state(2, s.title, line, nothing, s.records))
            .when((s.phase == 2) & line.rlike(DATE_LINE), state(3, s.title, s.company_line, line, s.records))
            .when(s.phase == 2, s)
            .otherwise(state(0, nothing, nothing, nothing, F.concat(s.records, record(s, line))))
            .cast(_STATE)
        )

    def finish(s: Column) -> Column:
        return F.when(s.phase == 3, F.concat(s.records, record(s, nothing))).otherwise(s.records)

    start = state(0, nothing, nothing, nothing, F.array().cast(f"array<{RECORD}>")).cast(_STATE)
    return F.aggregate(lines, start, step, finish)


def company_parts(line: Column) -> tuple[Column, Column]:
    """``company · type`` at the first dot; without a dot the type is null."""
    parts = F.split(line, "·", 2)
    return (
        F.when(F.contains(line, F.lit("·")), F.trim(parts[0])).otherwise(line),
        F.when(F.contains(line, F.lit("·")), F.trim(parts[1])),
    )


def parsed(documents: DataFrame) -> DataFrame:
    """Documents with their record array; a document with an ``error`` has none.

    The steps are separate columns: each array is made once and then read, where one
    nested expression would make it again for every mention.
    """
    begin, rest, stop = F.col("__begin"), F.col("__rest"), F.col("__stop")
    steps = (
        documents.withColumn("__lines", F.when(F.col("error").isNull(), document_lines(F.col("pages"))))
        .withColumn("__begin", F.array_position("__lines", START_MARKER).cast("int"))
        .withColumn("__rest", F.when(begin > 0, F.slice("__lines", begin + 1, F.size("__lines"))))
        .withColumn("__stop", _first_of(rest, END_MARKERS))
        .withColumn("__section", F.coalesce(_up_to(rest, stop), F.array().cast("array<string>")))
        .withColumn("records", F.when(F.col("error").isNull(), records(F.col("__section"))))
    )
    return steps.drop("__lines", "__begin", "__rest", "__stop", "__section")


def role_rows(parsed_documents: DataFrame) -> DataFrame:
    """One row per record, counted from 1."""
    rows = _exploded(parsed_documents, "records", "r")
    company, kind = company_parts(F.col("r.company_line"))
    return rows.select(
        "document_id", "source_file", (F.col("n") + 1).alias("role_index"), F.col("r.title").alias("title"), company.alias("company"),
        kind.alias("employment_type"), F.col("r.dates").alias("dates"), F.col("r.location").alias("location"),
    )


def document_status(parsed_documents: DataFrame) -> DataFrame:
    """(document_id, status, error_message) after parsing; one bad document is only FAILED."""
    n = F.size(F.coalesce("records", F.array().cast(f"array<{RECORD}>")))
    failed = F.col("error").isNotNull() | F.col("pages").isNull()
    return parsed_documents.select(
        "document_id",
        F.when(failed, "FAILED").when(n == 0, "NEEDS_REVIEW").otherwise("PARSED").alias("status"),
        F.when(failed, F.coalesce("error", F.lit("no text")))
        .when(n == 0, F.lit(NO_RECORDS))
        .alias("error_message"),
    )


def replace_roles(old: DataFrame, new: DataFrame, parsed_ids: DataFrame) -> DataFrame:
    """All records of re-parsed documents are replaced, so none of an older parse is left."""
    return old.join(parsed_ids.select("document_id").distinct(), "document_id", "left_anti").unionByName(new)
