"""Cleaning and typing of raw text, as plain Column expressions.

Everything stays inside whole-stage codegen. Nothing here raises on bad input:
a value that cannot be typed becomes null, and ``rejected`` tells the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. \z is the end of the text; $ would also accept a final newline.
SIGNED_DECIMAL = r"^-?\d+([.,]\d+)?\z"
DIGITS = r"^\d+\z"
FOUR_DIGITS = r"^\d{4}\z"
DAY_MONTH_YEAR = r"^\d{1,2}/\d{1,2}/\d{4}\z"
QUARTILE = r"^q?[1-4]\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim blanks; an empty rest is null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def lower_text(c: Column | str) -> Column:
    return F.nullif(F.lower(F.trim(_col(c))), F.lit(""))


def _dotted(c: Column) -> Column:
    return F.nullif(F.replace(c, F.lit(","), F.lit(".")), F.lit(""))


def decimal_comma(c: Column | str, precision: int, scale: int) -> Column:
    """Text with a decimal comma or point to decimal, half-up."""
    return _dotted(F.trim(_col(c))).try_cast(f"decimal({precision},{scale})")


def decimal_or_zero(c: Column | str, precision: int, scale: int) -> Column:
    """As ``decimal_comma`` with ``-`` as a placeholder; anything absent is 0."""
    text = F.nullif(F.trim(_col(c)), F.lit("-"))
    typed = _dotted(text).try_cast(f"decimal({precision},{scale})")
    return F.coalesce(typed, F.lit(0).cast(f"decimal({precision},{scale})"))


def signed_decimal(c: Column | str, precision: int, scale: int) -> Column:
    text = F.trim(_col(c))
    typed = F.replace(text, F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")
    return F.when(text.rlike(SIGNED_DECIMAL), typed)


def strict_int(c: Column | str) -> Column:
    """Digits only; a number too large for an int is null."""
    text = blank_to_null(c)
    return F.when(text.rlike(DIGITS), text.try_cast("int"))


def strict_year(c: Column | str) -> Column:
    text = blank_to_null(c)
    return F.when(text.rlike(FOUR_DIGITS), text.try_cast("int"))


def date_dmy(c: Column | str) -> Column:
    """D/M/YYYY with one or two digits; other shapes and impossible days are null. The parts are turned round,
    as a cast reads a date in a fraction of the time that a pattern takes."""
    text = blank_to_null(c)
    day, month, year = (F.split_part(text, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    return F.when(text.rlike(DAY_MONTH_YEAR), F.concat_ws("-", year, month, day).try_cast("date"))


def date_dmy_loose(c: Column | str) -> Column:
    """The same without the shape guard."""
    return F.try_to_date(blank_to_null(c), "d/M/yyyy")


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))


def code_chars(c: Column | str) -> Column:
    """Keep digits and X of an identifier, upper case."""
    return F.upper(F.regexp_replace(blank_to_null(c), "[^0-9Xx]", ""))


def dashed_code(c: Column | str) -> Column:
    """``####-####`` when the identifier has eight characters, else unchanged."""
    code = _col(c)
    dashed = F.concat(F.substring(code, 1, 4), F.lit("-"), F.substring(code, 5, 4))
    return F.when(F.length(code) == 8, dashed).otherwise(code)


def quartile(c: Column | str) -> Column:
    """``Q1``..``Q4`` or ``1``..``4`` to 1..4."""
    text = lower_text(c)
    return F.when(text.rlike(QUARTILE), F.right(text, F.lit(1)).cast("int"))


def name_key(c: Column | str) -> Column:
    """Trimmed, single-spaced, lower-case name; null becomes the empty text."""
    return F.lower(F.regexp_replace(F.coalesce(F.trim(_col(c)), F.lit("")), r"\s+", " "))


def full_name_key(c: Column | str) -> Column:
    """As ``name_key`` but null stays null, so that it never matches."""
    return F.lower(F.regexp_replace(F.trim(_col(c)), r"\s+", " "))


def nth_part(c: Column | str, separator: str, n: int) -> Column:
    return F.split_part(_col(c), F.lit(separator), F.lit(n))


def first_initial(c: Column | str) -> Column:
    return F.left(F.regexp_replace(_col(c), r"\.", ""), F.lit(1))


def text_of_all(*parts: Column) -> Column:
    """Concatenation that ignores nulls; use ``F.concat`` where null must win."""
    return F.concat_ws("", *parts)


def rejected(raw: Column | str, typed: Column) -> Column:
    """True where the raw text holds something but its typed value is null."""
    return blank_to_null(raw).isNotNull() & typed.isNull()
