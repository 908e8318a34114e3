"""Numeric column helpers: parsing, guarded division, rounding, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\x0c\r"

# Spark casts also accept suffixes such as "1d" and hexadecimal; the cheap first pattern keeps those out and settles
# nearly every number, the other two admit digit groups such as "1_000" and spelled-out infinities.
_PLAIN = r"^[0-9.eE+-]+$"
_GROUPED = r"^[+-]?[0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?([eE][+-]?[0-9]+(_[0-9]+)*)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` alone removes blanks only)."""
    return F.when(c.rlike(r"^\s|\s$"), F.btrim(c, F.lit(WHITE_SPACE))).otherwise(c)


def blank_as_null(c: Column) -> Column:
    """NULL for text without any visible character, else the text as it is."""
    return F.when(c.rlike(r"\S"), c)


def _plain_number(text: Column) -> Column:
    return (
        F.when(text.rlike(_PLAIN), text.try_cast("double"))
        .when(text.rlike(_GROUPED), F.translate(text, "_", "").try_cast("double"))
        .when(text.rlike(_INFINITY), text.try_cast("double"))
    )


def nan_to_null(c: Column) -> Column:
    """NaN marks a missing value in the inputs; Spark would order it above every number."""
    return F.when(~F.isnan(c), c)


def parse_number(c: Column) -> Column:
    """Text to double: commas dropped, ``"45%"`` becomes 0.45, anything unreadable becomes NULL."""
    text = strip(F.translate(c.cast("string"), ",", ""))
    body = strip(F.substring(text, F.lit(1), F.length(text) - 1))
    return F.when(text.endswith("%"), _plain_number(body) / 100.0).otherwise(_plain_number(text))


def to_number(c: Column) -> Column:
    """Text to double without the comma and percent rules: ``"5%"`` and ``"1,234"`` are unreadable, so NULL."""
    return _plain_number(strip(c.cast("string")))


def parse_year(c: Column) -> Column:
    """``"2024"``, ``"2024.0"`` or 2024.0 to 2024."""
    return F.regexp_replace(strip(c.cast("string")), r"\.0$", "").try_cast("int")


def parse_week(c: Column) -> Column:
    """First run of digits in the text (``"Week 07"`` is 7); 0 when there is none."""
    digits = F.nullif(F.regexp_extract(c.cast("string"), "([0-9]+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def div_or_null(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def div_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0, NULL when either is NULL."""
    return F.when(den == 0, F.lit(0.0)).otherwise(div_or_null(num, den))


def positive_part(c: Column) -> Column:
    """c where it is above 0, else 0 (also for NULL)."""
    return F.when(c > 0, c).otherwise(F.lit(0.0))


def negative_part(c: Column) -> Column:
    """c where it is below 0, else 0 (also for NULL)."""
    return F.when(c < 0, c).otherwise(F.lit(0.0))


def sum0(c: Column) -> Column:
    """Sum in which an all-NULL group gives 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def is_true(c: Column) -> Column:
    """A comparison with a missing value counts as false."""
    return F.coalesce(c, F.lit(False))


def round2_even(c: Column) -> Column:
    """Two decimals, halves to even."""
    return F.rint(c * 100) / 100


def is_close(a: Column, b: Column, rtol: float = 1e-2, atol: float = 1e-6) -> Column:
    """True when both are NULL, or when |a - b| <= atol + rtol * |b| with NULL read as 0."""
    x, y = F.coalesce(a.cast("double"), F.lit(0.0)), F.coalesce(b.cast("double"), F.lit(0.0))
    return (a.isNull() & b.isNull()) | (F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))


def performance_label(actual: Column, expected: Column, over: float = 0.05, under: float = -0.05) -> Column:
    """Band of (actual - expected) / expected; the bounds themselves are average performance."""
    diff = div_or_null(actual - expected, expected)
    return (
        F.when(diff.isNull(), "No Data")
        .when(diff > over, "Over Performing")
        .when(diff < under, "Under Performing")
        .otherwise("Average Performance")
    )
