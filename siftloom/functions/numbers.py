"""Number expressions: parsing, percentages, display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null, first_match

# First number in a text: optional minus, digits with grouping commas, optional fraction.
FIRST_NUMBER = r"(-?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+))"


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def parse_number(c: Column) -> Column:
    """First number in the text, grouping commas dropped, sign kept; else NULL."""
    return to_double(F.replace(first_match(c, FIRST_NUMBER), F.lit(","), F.lit("")))


def digits_only_number(c: Column) -> Column:
    """Number from the digits and dots alone, which loses the sign."""
    return to_double(blank_to_null(F.regexp_replace(c, r"[^0-9.]", "")))


def pct(n: Column, d: Column, digits: int = 2) -> Column:
    """``n`` as a percentage of ``d``; NULL when ``d`` is zero."""
    return F.round(F.try_divide(n.cast("double") * F.lit(100.0), d.cast("double")), digits)


def pct_text(n: Column, d: Column, digits: int = 2) -> Column:
    """A rounded percentage as text, without a trailing ``.0``."""
    return F.concat(F.regexp_replace(pct(n, d, digits).cast("string"), r"\.0$", ""), F.lit("%"))


def pct_fixed(n: Column, d: Column) -> Column:
    """A percentage with exactly one decimal, for display."""
    return F.format_string("%.1f%%", F.try_divide(n.cast("double") * F.lit(100.0), d.cast("double")))


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)
