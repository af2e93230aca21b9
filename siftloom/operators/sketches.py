"""Ranges and distinct counts of tables that grow, from sketches that are kept and merged.

A part of a table, say a day, is read once and gives one small row per column. Rows of all parts, stored side by side,
give the figures of the whole table, so a new part costs a pass over that part only. The exact operators stay the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import pct
from ..functions.text import is_present, rendered
from ..settings import DEFAULT, Settings
from .ranges import QUARTILES, parsed_numbers, range_columns
from .scale import long_form

#: Size of the quantile sketches: any quantile is off by less than 0.4 per cent of the ranks, with 99 per cent confidence.
KLL_SIZE, KLL_RANK_ERROR = 800, 0.004
#: Even steps of ranks at which a sketch is read to see how many lie outside of fences.
GRID = 1_000
#: 2 to this power values are kept by a distinct sketch: standard error below 0.8 per cent, exact for fewer values.
THETA_LOG, THETA_ERROR = 14, 0.008


def range_sketches(df: DataFrame, cfg: Settings = DEFAULT, columns: list[str] | None = None) -> DataFrame:
    """One row per numeric or number-like column of a part: ``variable, original_type``, counts, extremes, sum and a sketch."""
    columns = columns or range_columns(df, cfg)
    v, types = F.col("v"), dict(df.dtypes)
    kinds = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return parsed_numbers(df, columns, cfg).groupBy("variable").agg(
        F.count("*").alias("rows"), F.count("v").alias("parsed_count"), F.min("v").alias("min"), F.max("v").alias("max"), F.sum("v").alias("sum"),
        F.count_if(v < 0).alias("negative_count"), F.count_if(v == 0).alias("zero_count"),
        F.kll_sketch_agg_double(v, KLL_SIZE).alias("sketch")).withColumn("original_type", F.element_at(kinds, F.col("variable")))


def range_checks_from(sketches: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """``range_checks`` of all parts together, columns in the order of their names.

    Counts, sums and extremes are exact. Quartiles are off by ``KLL_RANK_ERROR`` of the ranks; the outlier count, a share of
    the ranks outside the fences, by one ``GRID``-th more.
    """
    merged = sketches.where("parsed_count > 0").groupBy("variable").agg(
        F.first("original_type").alias("original_type"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"),
        *[f(c).alias(c) for f, c in ((F.sum, "parsed_count"), (F.min, "min"), (F.max, "max"), (F.sum, "sum"),
                                     (F.sum, "negative_count"), (F.sum, "zero_count"))])
    rows = sketches.groupBy("variable").agg(F.sum("rows").alias("rows"))
    cuts = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in QUARTILES]))
    found = merged.join(rows, "variable").withColumn("q", cuts)
    spread = F.col("q")[2] - F.col("q")[0]
    low, high = F.col("q")[0] - cfg.iqr_multiplier * spread, F.col("q")[2] + cfg.iqr_multiplier * spread
    steps = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)]))
    outside = F.size(F.filter(steps, lambda v: (v < low) | (v > high))) / GRID
    return found.withColumn("outside", outside).orderBy("variable").select(
        "variable", "original_type", "parsed_count", pct(F.col("parsed_count"), F.col("rows")).alias("parsed_pct"), "min", F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"), (F.col("sum") / F.col("parsed_count")).alias("mean"), F.col("q")[2].alias("q3"), "max", "negative_count", "zero_count",
        F.round(F.col("outside") * F.col("parsed_count")).cast("bigint").alias("iqr_outlier_count"))


def distinct_sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """``variable, present, sketch``: the present values of each column of a part, as a set that unions and intersects."""
    tall = long_form(df, columns, [rendered(df, c) for c in columns]).where(is_present(F.col("value")))
    return tall.groupBy("variable").agg(F.count("*").alias("present"), F.theta_sketch_agg("value", THETA_LOG).alias("sketch"))


def distinct_from(sketches: DataFrame) -> DataFrame:
    """``variable, present, unique_count`` of all parts together; up to 2 to the ``THETA_LOG`` distinct values the count is exact."""
    merged = sketches.groupBy("variable").agg(F.sum("present").alias("present"), F.theta_union_agg("sketch", THETA_LOG).alias("sketch"))
    return merged.select("variable", "present", F.theta_sketch_estimate("sketch").alias("unique_count"))


def overlap(one: DataFrame, other: DataFrame) -> DataFrame:
    """``variable, one, other, both, either``: distinct values of two sketched tables, such as the keys of two scrapes."""
    def merged(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("variable").agg(F.theta_union_agg("sketch", THETA_LOG).alias(name))

    a, b = F.col("a"), F.col("b")
    return merged(one, "a").join(merged(other, "b"), "variable").select(
        "variable", F.theta_sketch_estimate(a).alias("one"), F.theta_sketch_estimate(b).alias("other"),
        F.theta_sketch_estimate(F.theta_intersection(a, b)).alias("both"), F.theta_sketch_estimate(F.theta_union(a, b, THETA_LOG)).alias("either"))
