"""Cleaning steps: each takes a table and returns the new table and its log entries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lists import distinct_urls
from ..functions.numbers import digits_only_number, parse_number
from ..functions.text import REPLACEMENT_CHAR, blank_to_null, first_match, fold_latin, free_name, named, trim_all
from ..settings import DEFAULT, Settings
from .duplicates import keep_first_per_key
from .roles import replace_column
from .sizes import SIZE_RULES, SizeRule, add_size_columns

# The patterns of the cleaning rules.
SKU_PREFIX = r"^SKU:\s*"
BRAND_HEAD = f"^[^?{REPLACEMENT_CHAR}]+"
COLOR = r"'Color':\s*'([^']+)"
COLOR_ONE_SPACE = r"'Color':\s'([^']+)"


@dataclass(frozen=True)
class LogEntry:
    """What happened to a column and why."""

    column: str
    action: str
    reason: str


Step = tuple[DataFrame, list[LogEntry]]


def clean_sku_text(df: DataFrame, column: str = "sku") -> DataFrame:
    return df.withColumn(column, trim_all(F.regexp_replace(column, SKU_PREFIX, "")))


def clean_sku(df: DataFrame, cfg: Settings = DEFAULT, column: str = "sku") -> Step:
    """Prefix off, trimmed, first row per SKU. A table without the column passes unchanged."""
    if column not in df.columns:
        return df, []
    return keep_first_per_key(clean_sku_text(df, column), column, cfg), []


# A minus before the currency mark, or the whole amount in brackets.
MINUS_FIRST = r"^\s*-\s*[^0-9.,()\-]{1,4}\s*[0-9.]"
IN_BRACKETS = r"^\s*\(\s*[^0-9.,()\-]{0,4}\s*[0-9.,]+\s*\)\s*$"


def price_number(c: Column, cfg: Settings = DEFAULT) -> Column:
    """Price as a number; ``-$5.00`` and ``($5.00)`` are negative. As coded the sign is lost and ``$5.00-$7.00`` does
    not parse."""
    if cfg.as_coded:
        return digits_only_number(c)
    number = parse_number(c)
    return F.when(c.rlike(MINUS_FIRST) | c.rlike(IN_BRACKETS), -F.abs(number)).otherwise(number)


def price_flag(price: Column, cfg: Settings = DEFAULT) -> Column:
    return (F.when(price.isNull(), "missing").when(price <= 0, "invalid")
            .when(price > cfg.price_outlier, "outlier_high").otherwise("ok"))


def clean_price(df: DataFrame, column: str | None, cfg: Settings = DEFAULT) -> Step:
    """The price column becomes the number ``price``, with ``price_flag`` beside it.

    Another column that is called ``price`` stays as ``price_other``.
    """
    if column is None or column not in df.columns:
        return df, []
    log = []
    if column != "price" and "price" in df.columns:
        df = df.withColumnRenamed("price", "price_other")
        log.append(LogEntry("price", "renamed", f"kept as price_other, as {column} becomes the column price"))
    name = free_name(df.columns, "__price")
    number = df.withColumn(name, price_number(named(column).cast("string"), cfg))
    flagged = number.withColumn("price_flag", price_flag(F.col(name), cfg))
    priced = replace_column(flagged, column, name)
    if column != "price":
        priced = priced.withColumnRenamed(column, "price")
    return priced, [*log, LogEntry(column, "replaced", "text without currency marks, as a number; price_flag tells"
                                                " missing, invalid and very high prices apart")]


def brand_name(c: Column) -> Column:
    """The text before the first ``?`` or broken character, in ASCII; blank is NULL."""
    return blank_to_null(trim_all(F.regexp_extract(fold_latin(c), BRAND_HEAD, 0)))


def clean_brand(df: DataFrame, column: str = "brand") -> Step:
    if column not in df.columns:
        return df, []
    return df.withColumn(column, brand_name(F.col(column))), []


def color_name(c: Column, one_space: bool = False) -> Column:
    """First colour of an attribute text; the older rule wants exactly one blank after the colon."""
    return first_match(c, COLOR_ONE_SPACE if one_space else COLOR)


def extract_color(df: DataFrame, column: str = "description", one_space: bool = False) -> Step:
    if column not in df.columns:
        return df, []
    colored = df.withColumn("color", color_name(F.col(column), one_space)).drop(column)
    return colored, [LogEntry(column, "dropped", "serialised attributes; only the colour is kept, as column color,"
                                                 " the others are too sparse")]


def clean_size(df: DataFrame, column: str = "size", rules: tuple[SizeRule, ...] = SIZE_RULES) -> Step:
    if column not in df.columns:
        return df, []
    sized = add_size_columns(df, column, rules).drop(column)
    return sized, [LogEntry(column, "replaced", "mixes several size systems; replaced by size_system, size_labels,"
                                                " size_us, size_eu, dimensions_raw, waist, inseam, size_count and"
                                                " has_petite, has_tall, has_plus, empty where they do not apply")]


def image_columns(c: Column, cfg: Settings = DEFAULT) -> tuple[Column, Column]:
    """(``images_clean``, ``images_n``): distinct URLs joined by `` | ``, and how many.

    As coded only ``https`` counts, no URL counts as one, and NULL becomes ``NA``.
    """
    urls = distinct_urls(c, https_only=cfg.as_coded)
    if cfg.as_coded:
        return (F.when(c.isNull(), F.lit("NA")).otherwise(F.array_join(urls, " | ")),
                F.coalesce(F.greatest(F.size(urls), F.lit(1)), F.lit(1)))
    return F.array_join(urls, " | "), F.when(c.isNotNull(), F.size(urls))


def clean_images(df: DataFrame, column: str = "images", cfg: Settings = DEFAULT) -> Step:
    if column not in df.columns:
        return df, []
    joined, n = image_columns(F.col(column), cfg)
    cleaned = df.select("*", joined.alias("images_clean"), n.alias("images_n")).drop(column)
    return cleaned, [LogEntry(column, "replaced", "serialised list; replaced by images_clean (distinct URLs) and"
                                                  " images_n (their number)")]
