"""Tolerant parsing of text columns.  Bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import as_col

__all__ = [
    "parse_number",
    "parse_columns",
    "comma_decimal",
    "number_or_null",
    "normalize_code",
    "period_year",
    "year_or_null",
    "yes_no_flag",
    "like_flag",
    "equals_flag",
    "first_number",
]

# The six characters that publishers use in place of an ASCII full stop
# (middle dot, bullet operator, dot operator, bullet, one dot leader, katakana middle dot).
DOT_LOOKALIKES = "·∙⋅•․・"

# One optional sign, digits with at most one point and at least one digit, optional exponent.
NUMBER_SHAPE = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"
# Every point of a text whose points group thousands: there is a comma, or a second point, or the
# text is of the kind '386.466'.  The test is made at the start; \G carries it along.
GROUPING_POINT = r"(?:^(?=.*,|.*\..*\.|\d{1,3}\.\d{3}$)|(?!^)\G)([^.]*)\."


# Common plain form: needs none of the rewriting and cannot be read in two ways.
PLAIN_NUMBER = r"^[-+]?\d{1,15}(?:\.(?:\d{1,2}|\d{4,15}))?$"
# Likewise a decimal comma alone, and grouping points alone.
COMMA_NUMBER = r"^[-+]?\d{1,15},\d{1,15}\z"
GROUPED_NUMBER = r"^\d{1,3}(?:\.\d{3}){1,4}\z"


def parse_number(c: Column | str) -> Column:
    """Double from text written with either decimal mark.

    A comma is always the decimal mark and points beside it group thousands.  Without a comma,
    points are read as grouping when they cannot be a decimal mark.  `NaN`, infinities, suffixed
    literals such as `1d` and numbers beyond the double range are null.

    The rewriting is a chain that names its input once.  The optimizer copies filters on the
    result below the projection, and a branching form would multiply with every copy until the
    generated code is too large to compile.
    """
    trimmed = F.trim(as_col(c).cast("string"))
    text = F.translate(trimmed, DOT_LOOKALIKES, "." * len(DOT_LOOKALIKES))
    plain = F.translate(F.regexp_replace(text, GROUPING_POINT, "$1"), ",", ".")
    value = F.regexp_extract(plain, NUMBER_SHAPE, 0).try_cast("double")
    return (
        F.when(trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double"))
        .when(trimmed.rlike(COMMA_NUMBER), F.translate(trimmed, ",", ".").try_cast("double"))
        .when(trimmed.rlike(GROUPED_NUMBER), F.translate(trimmed, ".", "").try_cast("double"))
        .when(F.abs(value) < float("inf"), value)
    )


def parse_columns(df, columns: list[str]):
    """Parse those of `columns` that `df` has, in a single projection."""
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    return df.withColumns({c: parse_number(c) for c in present})


def comma_decimal(c: Column | str) -> Column:
    """Double from text whose only irregularity is a decimal comma."""
    return F.replace(as_col(c), F.lit(","), F.lit(".")).try_cast("double")


def number_or_null(c: Column | str, to: str = "double") -> Column:
    return as_col(c).try_cast(to)


def normalize_code(c: Column | str, width: int = 5) -> Column:
    """Trimmed code, zero-padded on the left; blank is null, longer codes are cut to `width`."""
    return F.lpad(F.nullif(F.trim(as_col(c).cast("string")), F.lit("")), width, "0")


def period_year(c: Column | str) -> Column:
    """Year held in the first four characters of a period such as `20231`."""
    return F.substring(F.trim(as_col(c).cast("string")), 1, 4).try_cast("int")


def year_or_null(c: Column | str) -> Column:
    return F.trim(as_col(c).cast("string")).try_cast("int")


def yes_no_flag(c: Column | str, yes: str = "SI", no: str = "NO") -> Column:
    """1, 0 or null, whatever the letter case and the surrounding blanks."""
    answer = F.upper(F.trim(as_col(c).cast("string")))
    return F.when(answer == yes, 1).when(answer == no, 0).cast("int")


def like_flag(c: Column | str, pattern: str) -> Column:
    """1 when the text matches a LIKE pattern, otherwise 0 (null counts as 0)."""
    return F.when(as_col(c).like(pattern), 1).otherwise(0).cast("int")


def equals_flag(c: Column | str, *values: object) -> Column:
    """1 when the value is one of `values`, otherwise 0 (null counts as 0)."""
    return F.when(as_col(c).isin(*values), 1).otherwise(0).cast("int")


def first_number(c: Column | str) -> Column:
    """First run of digits inside a text, as double; null when there is none."""
    digits = F.regexp_extract(F.trim(as_col(c).cast("string")), r"(\d+)", 1)
    return digits.try_cast("double")
