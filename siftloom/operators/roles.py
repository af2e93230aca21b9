"""Column roles: which column plays product name, price, discount and so on.

Only column names and types are read here, never rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import named

# Name patterns per role, matched on lower-cased names in column order.
STRICT_PATTERNS = {
    "product": r"product.*name|product_name|title|^name$",
    "price": r"^price$|sale.*price|current.*price|price",
    "discount": r"discount|markdown|promo",
    "color": r"colou?r",
    "size": r"^size$|sizes",
    "category": r"category|department|class",
    "material": r"material|fabric",
    "product_url": r"product.*url|^url$|^link$",
    "image_url": r"image.*url|^image$|^img$",
    "scraped_at": r"scraped|timestamp|scraped_at",
}

# The older, looser patterns.
LOOSE_PATTERNS = {
    "product": r"product.*name|product_name|title|name",
    "price": r"^price$|price|sale.*price|current.*price",
    "discount": r"discount|markdown|promo",
    "color": r"color|colour",
    "size": r"^size$|sizes",
    "category": r"category|department|class",
    "material": r"material|fabric",
    "product_url": r"product.*url|url|link",
    "image_url": r"image.*url|image|img",
    "scraped_at": r"scraped|date|time|timestamp",
}

# Fixed value: names that suggest a number.
NUMERIC_NAMES = r"price|cost|amount|discount|rating|review|stock|quantity|qty|count|sales|weight"

Roles = dict[str, str | None]


def find_column(columns: list[str], pattern: str) -> str | None:
    """First column, in order, whose lower-cased name matches."""
    return next((c for c in columns if re.search(pattern, c.lower())), None)


def detect_roles(df: DataFrame, patterns: dict[str, str] = STRICT_PATTERNS) -> Roles:
    return {role: find_column(df.columns, pattern) for role, pattern in patterns.items()}


def present_rows(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """Add ``present_rows``: how many rows have a value in the column of ``df`` that ``listed[column]`` names."""
    counts = df.agg(*[F.count_if(~missing_in(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias(column), F.col(f"n{i}").alias("present_rows")) for i, c in enumerate(df.columns)])
    # One row per column: the schema bounds what is broadcast.
    return listed.join(F.broadcast(counts.select(F.inline(pairs))), column, "left").select(*listed.columns, "present_rows")


def detected_columns(df: DataFrame, roles: Roles) -> DataFrame:
    """``expected_field, detected_column, present_rows``; NULL where no column fits."""
    listed = df.sparkSession.createDataFrame(list(roles.items()), "expected_field string, detected_column string")
    return present_rows(df, listed, "detected_column")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def missing_in(df: DataFrame, column: str) -> Column:
    """NULL, the empty string where the column is text, NaN where it is a number; numbers are not rendered to find out."""
    c, kind = named(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull() | F.isnan(c) if isinstance(kind, (T.FloatType, T.DoubleType)) else c.isNull()


def numeric_like_columns(df: DataFrame) -> list[str]:
    """Numeric columns, then columns with a number-like name, each once."""
    named = [c for c in df.columns if re.search(NUMERIC_NAMES, c.lower())]
    return list(dict.fromkeys(numeric_columns(df) + named))


def priority_first(df: DataFrame, priority: list[str]) -> DataFrame:
    """The priority columns that exist, in that order, then all others."""
    ahead = [c for c in priority if c in df.columns]
    return df.select(*[named(c) for c in [*ahead, *[c for c in df.columns if c not in ahead]]])


def replace_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Let ``new`` take the name of ``old``."""
    return df.drop(old).withColumnRenamed(new, old)
