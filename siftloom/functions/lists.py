"""Expressions over serialised lists and key/value texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import all_matches, trim_ascii

KEY_VALUE = r"'([^']+)'\s*:\s*'([^']*)'"


def list_elements(c: Column) -> Column:
    """``"['a', 'b']"`` to ``array('a', 'b')``; a trailing empty piece is dropped."""
    pieces = F.split(F.regexp_replace(c, r",\s*$", ""), r",\s*")
    return F.transform(pieces, lambda x: trim_ascii(F.regexp_replace(x, r"[\[\]']", "")))


def has_repeats(array: Column) -> Column:
    return F.size(array) != F.size(F.array_distinct(array))


def key_value_pairs(c: Column) -> Column:
    """All ``'key': 'value'`` pairs of a text, in order, as an array of structs."""
    return F.arrays_zip(
        all_matches(c, KEY_VALUE, 1).alias("attribute_name"),
        all_matches(c, KEY_VALUE, 2).alias("attribute_value"),
    )


def distinct_urls(c: Column, https_only: bool = False) -> Column:
    """Every URL of a serialised list once, in first-seen order."""
    scheme = "https://" if https_only else "https?://"
    return F.array_distinct(all_matches(c, "(" + scheme + r"[^'\"\]]+)", 1))
