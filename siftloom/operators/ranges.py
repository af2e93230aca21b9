"""Numeric ranges, outliers and values that do not parse as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import parse_number, pct
from ..functions.text import is_numeric_missing, named
from ..settings import DEFAULT, Settings
from .roles import numeric_columns, numeric_like_columns
from .scale import long_form, quantiles_and_stats

QUARTILES = [0.25, 0.5, 0.75]
PARSE_ISSUE = "Value could not be parsed as a number"


def _parsed(df: DataFrame, column: str, cfg: Settings) -> Column:
    c = named(column)
    if column in numeric_columns(df):
        return c.cast("double")
    return F.when(~is_numeric_missing(c, cfg.numeric_missing_words), parse_number(c))


def range_columns(df: DataFrame, cfg: Settings = DEFAULT) -> list[str]:
    return cfg.data_columns(numeric_like_columns(df))


_RANGE_SCHEMA = (
    "variable string, original_type string, parsed_count bigint, parsed_pct double, min double, q1 double,"
    " median double, mean double, q3 double, max double, negative_count bigint, zero_count bigint,"
    " iqr_outlier_count bigint")


def range_checks(df: DataFrame, cfg: Settings = DEFAULT, columns: list[str] | None = None,
                 approx: bool = False) -> DataFrame:
    """Range, quartiles and outlier count per numeric or number-like column.

    Outliers lie strictly outside ``q1 - k*IQR`` and ``q3 + k*IQR``. Columns
    without any number are left out. ``approx=True`` trades exact quartiles for
    fewer passes over the data.
    """
    columns = columns or range_columns(df, cfg)
    if not columns:
        return df.sparkSession.createDataFrame([], _RANGE_SCHEMA)
    return range_checks_of(parsed_numbers(df, columns, cfg), columns, dict(df.dtypes), cfg, approx)


def parsed_numbers(df: DataFrame, columns: list[str], cfg: Settings = DEFAULT) -> DataFrame:
    """``variable, v``: every field of the columns as a number, NULL where it is none."""
    return long_form(df, columns, [F.nanvl(_parsed(df, c, cfg), F.lit(None).cast("double")) for c in columns], value="v")


def range_checks_of(tall: DataFrame, columns: list[str], types: dict[str, str], cfg: Settings = DEFAULT, approx: bool = False) -> DataFrame:
    """``range_checks`` from the parsed numbers, which are read several times."""
    v = F.col("v")
    stats = {
        "rows": (F.count("*"), F.sum("rows")), "parsed_count": (F.count("v"), F.sum("parsed_count")),
        "min": (F.min("v"), F.min("min")), "max": (F.max("v"), F.max("max")), "sum": (F.sum("v"), F.sum("sum")),
        "negative_count": (F.count_if(v < 0), F.sum("negative_count")), "zero_count": (F.count_if(v == 0), F.sum("zero_count"))}
    if approx:
        cuts = F.percentile_approx("v", F.array(*[F.lit(p) for p in QUARTILES]), 10_000)
        found = tall.groupBy("variable").agg(cuts.alias("c"), *[inner.alias(name) for name, (inner, _) in stats.items()]) \
            .select("*", *[F.col("c")[i].alias(f"q{i}") for i in range(3)]).where("parsed_count > 0")
    else:
        found = quantiles_and_stats(tall, "variable", "v", QUARTILES, stats, few_groups=True)
    spread = F.col("q2") - F.col("q0")
    fences = found.withColumns({"low": F.col("q0") - cfg.iqr_multiplier * spread, "high": F.col("q2") + cfg.iqr_multiplier * spread})
    # Only the outliers need a pass of their own. One row per checked column: the schema bounds what is broadcast.
    counted = tall.where(v.isNotNull()).join(F.broadcast(fences), "variable").groupBy("variable").agg(
        F.count_if((v < F.col("low")) | (v > F.col("high"))).alias("iqr_outlier_count"),
        *[F.first(c).alias(to) for c, to in (("q0", "q1"), ("q1", "median"), ("q2", "q3"), *((c, c) for c in stats))])
    stats = counted.withColumn("mean", F.col("sum") / F.col("parsed_count"))
    names = F.array(*[F.lit(c) for c in columns])
    position = F.array_position(names, F.col("variable")).cast("int")
    return (stats
            .withColumn("original_type", F.element_at(F.array(*[F.lit(types[c]) for c in columns]), position))
            .withColumn("parsed_pct", pct(F.col("parsed_count"), F.col("rows")))
            .orderBy(position)
            .select("variable", "original_type", "parsed_count", "parsed_pct", "min", "q1", "median", "mean", "q3",
                    "max", "negative_count", "zero_count", "iqr_outlier_count"))


def parse_failure_count(df: DataFrame, cfg: Settings = DEFAULT) -> Column:
    """How many number-like fields of a row are neither number nor missing; row-local."""
    numeric = set(numeric_columns(df))
    count = F.lit(0)
    for c in range_columns(df, cfg):
        if c not in numeric:
            count = count + F.coalesce(_unparsed(c, cfg), F.lit(False)).cast("int")
    return count


def _unparsed(column: str, cfg: Settings) -> Column:
    c = named(column)
    return ~is_numeric_missing(c, cfg.numeric_missing_words) & parse_number(c).isNull()


def numeric_parse_issues(df: DataFrame, cfg: Settings = DEFAULT, columns: list[str] | None = None) -> DataFrame:
    """``variable, row_number, original_value, issue`` for values that are neither number nor missing."""
    numeric = set(numeric_columns(df))
    columns = [c for c in (columns or range_columns(df, cfg)) if c not in numeric]
    if not columns:
        return df.sparkSession.createDataFrame(
            [], f"variable string, {cfg.row_id} bigint, original_value string, issue string")
    bad = [F.when(_unparsed(c, cfg), named(c)) for c in columns]
    tall = long_form(df, columns, bad, keep=[cfg.row_id], value="original_value")
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("variable"))
    return (tall.where(F.col("original_value").isNotNull()).orderBy(order, cfg.row_id)
            .select("variable", cfg.row_id, "original_value", F.lit(PARSE_ISSUE).alias("issue")))
