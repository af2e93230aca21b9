"""Cleaning the documents ask for beyond the coded steps: latest scrape, repairs, imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import parse_timestamp
from ..functions.lists import list_elements
from ..functions.numbers import parse_number
from ..functions.text import first_match, free_name, is_present, is_web_url, named, needs_care, squish
from ..settings import DEFAULT, Settings
from .profile import high_missing_columns, missingness_by_variable
from .roles import missing_in, numeric_columns, text_columns
from ..sources.identity import pin
from .scale import last_per_key, long_form, quantiles_and_stats

# Scrape day as it appears in image paths.
PATH_DATE = r"/(\d{4}/\d{2}/\d{2})/"


def latest_per_key(df: DataFrame, key: str, stamp: str, cfg: Settings = DEFAULT) -> DataFrame:
    """Of the rows with a present key the latest per key; earlier rows win ties, rows without a date lose."""
    at = parse_timestamp(F.col(stamp), cfg.date_orders)
    return last_per_key(df.where(is_present(F.col(key))), [key], F.struct(at, -F.col(cfg.row_id)))


def clean_discount(df: DataFrame, column: str = "discount") -> DataFrame:
    """Discount as a number of at most 100, with ``discount_flag`` for what was wrong with it."""
    name = free_name(df.columns, "__d")
    number = df.withColumn(name, parse_number(F.col(column)))
    d = F.col(name)
    flag = (F.when(~is_present(F.col(column)), "missing").when(d.isNull(), "unparsed")
            .when((d > 100) | (d < 0), "invalid").otherwise("ok"))
    return number.withColumn("discount_flag", flag).withColumn(
        column, F.when(d.isNotNull(), F.least(d, F.lit(100.0)))).drop(name)


def repaired_url(c: Column) -> Column:
    """Web URLs as they are, ``www.`` hosts with a scheme put in front, anything else NULL."""
    return F.when(is_web_url(c), c).when(c.rlike(r"^www\."), F.concat(F.lit("https://"), c))


def repair_url(df: DataFrame, column: str = "url") -> DataFrame:
    return df.withColumn(column, repaired_url(F.col(column)))


def squish_all(df: DataFrame) -> DataFrame:
    """Every text column squished; line breaks become blanks."""
    texts = set(text_columns(df))
    return df.select(*[F.when(needs_care(F.col(c)), squish(F.col(c))).otherwise(F.col(c)).alias(c)
                       if c in texts else F.col(c) for c in df.columns])


def imputation_plan(df: DataFrame, cfg: Settings = DEFAULT, exclude_pct: float | None = None) -> DataFrame:
    """``variable, missing_pct, decision``: keep, impute, document when too much is missing, or exclude from ``exclude_pct`` on."""
    missingness = missingness_by_variable(df, cfg)
    too_many = F.col("missing_pct") >= cfg.high_missing_pct
    out = F.lit(False) if exclude_pct is None else F.col("missing_pct") >= exclude_pct
    return missingness.select(
        "variable", "missing_pct",
        F.when(F.col("missing_count") == 0, "keep").when(out, "exclude").when(too_many, "document").otherwise("impute").alias("decision"))


def documented_only(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    return high_missing_columns(missingness_by_variable(df, cfg), cfg)


def impute_by_group(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Fill gaps from the row's group: the median for numbers, the most frequent value for texts.

    Columns keep their types: medians of whole-number columns are rounded, halves up.
    ``<column>_imputed`` marks filled cells; groups without any value stay empty,
    and rows without a group are a group of their own.
    """
    return impute_by_levels(df, [[group]], columns).drop(*[f"{c}_imputed_from" for c in columns])


def impute_by_levels(df: DataFrame, levels: list[list[str]], columns: list[str]) -> DataFrame:
    """``impute_by_group`` with something to fall back on: each level is a list of columns whose values make a group, and
    ``[]`` is the whole table. A gap is filled from the first level whose group has a value.

    ``<column>_imputed`` marks filled cells and ``<column>_imputed_from`` names the level, its columns or ``all``. What
    the fills are taken from is written once, narrow; all levels are counted together.
    """
    numbers = [c for c in columns if c in numeric_columns(df)]
    texts = [c for c in columns if c not in numbers]
    keys = list(dict.fromkeys(c for level in levels for c in level))
    source = pin(df.select(*[named(c) for c in dict.fromkeys([*keys, *columns])]))
    groups = F.array(*[F.struct(F.lit(i).alias("level"), _group_key(level).alias("group")) for i, level in enumerate(levels)])
    at = free_name(source.columns, "groups")
    placed = source.withColumn(at, groups)
    fills = []
    if numbers:
        tall = long_form(placed, numbers, [named(c).cast("double") for c in numbers], keep=[at], value="v").where("v IS NOT NULL")
        keyed = tall.select(F.explode(at).alias("g"), "variable", "v").select(F.struct("g.level", "g.group", "variable").alias("key"), "v")
        few = placed.select(F.explode(at).alias("g")).distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
        medians = quantiles_and_stats(keyed, "key", "v", [0.5], few_groups=few)
        fills.append(medians.select("key.level", "key.group", "key.variable", F.col("q0").alias("number"), F.lit(None).cast("string").alias("text")))
    if texts:
        tall = long_form(placed, texts, [named(c) for c in texts], keep=[at]).where(is_present(F.col("value")))
        per_value = tall.groupBy(at, "variable", "value").agg(F.count("*").alias("n")).select(F.explode(at).alias("g"), "variable", "value", "n")
        counts = per_value.groupBy("g.level", "g.group", "variable", "value").agg(F.sum("n").alias("n"))
        # Most frequent first; among equals the first in text order.
        modes = counts.groupBy("level", "group", "variable").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("text"))
        fills.append(modes.select("level", "group", "variable", F.lit(None).cast("double").alias("number"), "text"))
    both = fills[0] if len(fills) == 1 else fills[0].unionByName(fills[1])
    wide = pin(both.groupBy("level", "group").agg(*[
        F.max(F.when(F.col("variable") == c, F.col("number" if c in numbers else "text"))).alias(f"fill_{i}") for i, c in enumerate(columns)]))
    joined, found = df, []
    for k, level in enumerate(levels):
        key, row = free_name(joined.columns, f"__group_{k}"), free_name(joined.columns, f"__fills_{k}")
        side = wide.where(F.col("level") == k).select(F.col("group").alias(key), F.struct(*[f"fill_{i}" for i in range(len(columns))]).alias(row))
        joined = joined.withColumn(key, _group_key(level)).join(side, key, "left")
        found.append(row)
    present = {c: ~missing_in(df, c) for c in columns}

    def fill(i: int, c: str) -> Column:
        kind, value = df.schema[c].dataType, F.coalesce(*[F.col(f"`{row}`.fill_{i}") for row in found])
        return F.round(value).cast(kind) if isinstance(kind, T.IntegralType) else value.cast(kind)

    filled = {c: F.coalesce(F.when(present[c], named(c)), fill(i, c)).alias(c) for i, c in enumerate(columns)}
    flags = [(~present[c] & fill(i, c).isNotNull()).alias(f"{c}_imputed") for i, c in enumerate(columns)]
    names = [" ".join(level) or "all" for level in levels]
    source_of = [F.when(~present[c], F.coalesce(*[F.when(F.col(f"`{row}`.fill_{i}").isNotNull(), F.lit(n)) for row, n in zip(found, names)]))
                 .alias(f"{c}_imputed_from") for i, c in enumerate(columns)]
    return joined.select(*[filled.get(c, named(c)) for c in df.columns], *flags, *source_of)


#: Groups up to which the buckets that hold their medians are broadcast.
FEW_GROUPS = 10_000


def _group_key(level: list[str]) -> Column:
    """One text for the values of a level's columns; missing ones differ from all others."""
    return F.to_json(F.struct(*[named(c).cast("string").alias(f"c{i}") for i, c in enumerate(level)]), {"ignoreNullFields": "false"}) if level else F.lit("{}")


def image_scrape_dates(df: DataFrame, column: str = "images", cfg: Settings = DEFAULT) -> DataFrame:
    """``row_number, scrape_date``: the distinct days that occur in a row's image paths."""
    dates = F.array_distinct(F.array_compact(F.transform(
        list_elements(F.col(column)), lambda u: F.replace(first_match(u, PATH_DATE), F.lit("/"), F.lit("-")))))
    return df.where(is_present(F.col(column))).select(cfg.row_id, F.explode(dates).alias("scrape_date"))
