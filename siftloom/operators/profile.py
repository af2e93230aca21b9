"""Profiles of a whole table: size, types, missing values, texts, levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import pct
from ..functions.text import (
    bounded_key, has_edge_space, has_line_break, has_space_run, is_missing, is_present, named, needs_care, rendered, sanitise,
)
from ..settings import DEFAULT, Settings
from .roles import Roles, missing_in, text_columns
from .scale import long_form, row_identity, sum_all, top_n_per_group, wide_to_rows


# Missing-field bits per word.
_WORD = 60


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def overview(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """``metric, value``: rows, columns, cells, exact duplicates, rows and columns with gaps.

    Copies of a row share their missing fields, so one grouping by row identity
    serves all six numbers; the missing fields ride along as bits.
    """
    columns = cfg.data_columns(df.columns)
    keys = row_identity(df, columns)
    per_row = df.select(*keys, *[m.alias(f"gaps_{w}") for w, m in enumerate(gap_masks(df, columns))])
    return overview_of(per_row.groupBy(*per_row.columns).agg(F.count("*").alias("n")), columns)


def gap_masks(df: DataFrame, columns: list[str]) -> list[Column]:
    """The missing fields of a row as bits, ``_WORD`` columns per number."""
    flags = [_flag(missing_in(df, c)).cast("long") for c in columns]
    return [sum_all([F.shiftleft(f, bit) for bit, f in enumerate(flags[i:i + _WORD])]) for i in range(0, len(flags), _WORD)]


def gap_in(i: int) -> Column:
    """Whether the ``i``-th column is missing, from ``gaps_0``, ``gaps_1``, ..."""
    return F.getbit(f"gaps_{i // _WORD}", F.lit(i % _WORD)) == 1


def overview_of(per_digest: DataFrame, columns: list[str]) -> DataFrame:
    """``overview`` from one row per distinct row: ``n`` copies and their missing fields."""
    words = range(-(-len(columns) // _WORD))

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    any_gap = sum_all([(F.col(f"gaps_{w}") != 0).cast("int") for w in words]) > 0
    total = per_digest.agg(
        rows_where(F.lit(True)).alias("n"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"),
        rows_where(any_gap).alias("gap_rows"),
        *[rows_where(gap_in(i)).alias(f"m{i}") for i in range(len(columns))])
    width = F.lit(len(columns)).cast("long")
    gap_columns = sum_all([(F.col(f"m{i}") > 0).cast("long") for i in range(len(columns))])
    return wide_to_rows(total, [
        [F.lit("Total rows"), F.col("n")],
        [F.lit("Total columns"), width],
        [F.lit("Total cells"), F.col("n") * width],
        [F.lit("Exact duplicate rows"), F.col("copies")],
        [F.lit("Rows with ≥1 missing value"), F.col("gap_rows")],
        [F.lit("Columns with ≥1 missing value"), gap_columns],
    ], ["metric", "value"])


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``ordinal, variable, missing_count, rows`` from a single pass without a row shuffle."""
    totals = df.agg(F.count("*").alias("rows"),
                    *[F.count_if(missing_in(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
    return wide_to_rows(
        totals,
        [[F.lit(i), F.lit(c), F.col(f"m{i}"), F.col("rows")] for i, c in enumerate(columns)],
        ["ordinal", "variable", "missing_count", "rows"])


def missingness_by_variable(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """``variable, missing_count, non_missing, missing_pct``, most missing first, ties in column order."""
    return missingness_of(missing_counts(df, cfg.data_columns(df.columns)))


def missingness_of(counts: DataFrame) -> DataFrame:
    """``missingness_by_variable`` from ``ordinal, variable, missing_count, rows``."""
    return (counts
            .withColumn("missing_pct", pct(F.col("missing_count"), F.col("rows")))
            .orderBy(F.desc("missing_pct"), "ordinal")
            .select("variable", "missing_count",
                    (F.col("rows") - F.col("missing_count")).alias("non_missing"), "missing_pct"))


def high_missing_columns(missingness: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    return missingness.where(F.col("missing_pct") >= cfg.high_missing_pct)


def missing_summary(df: DataFrame) -> DataFrame:
    """``variable, missing_count`` for every column, most missing first."""
    return (missing_counts(df, df.columns).orderBy(F.desc("missing_count"), "ordinal")
            .select("variable", "missing_count"))


def missingness_by_row(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """``missing_values_per_row, row_count``; at most one group per column count."""
    per_row = sum_all([_flag(missing_in(df, c)) for c in cfg.data_columns(df.columns)])
    return (df.groupBy(per_row.alias("missing_values_per_row")).agg(F.count("*").alias("row_count"))
            .orderBy(F.desc("missing_values_per_row")))


def variable_types(df: DataFrame, cfg: Settings = DEFAULT, approx: bool = False) -> DataFrame:
    """``variable, type, non_missing_count, missing_count, unique_count, missing_pct``.

    NULL counts as one value of its own. Exact counting shuffles one bounded key
    per distinct value; ``approx=True`` uses a sketch in a single pass instead.
    """
    columns = cfg.data_columns(df.columns)
    types = dict(df.dtypes)
    tall = long_form(df, columns, [rendered(df, c) for c in columns])
    if approx:
        stats = tall.groupBy("variable").agg(
            F.count("*").alias("rows"), F.count_if(is_missing(F.col("value"))).alias("missing_count"),
            (F.approx_count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("unique_count"))
    else:
        return variable_types_of(tall.groupBy("variable", bounded_key(F.col("value")).alias("key")).agg(F.count("*").alias("n")), columns, types)
    return _types_of(stats, columns, types)


def variable_types_of(per_value: DataFrame, columns: list[str], types: dict[str, str]) -> DataFrame:
    """``variable_types`` from ``variable, key, n``: how often each value of each column occurs."""
    return _types_of(per_value.groupBy("variable").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(is_missing(F.col("key")), F.col("n"))), F.lit(0)).alias("missing_count"),
        F.count("*").alias("unique_count")), columns, types)


def _types_of(stats: DataFrame, columns: list[str], types: dict[str, str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    type_of = F.element_at(F.array(*[F.lit(types[c]) for c in columns]), F.array_position(names, F.col("variable")).cast("int"))
    return (stats
            .withColumn("missing_pct", pct(F.col("missing_count"), F.col("rows")))
            .withColumn("type", type_of)
            .orderBy(F.desc("missing_pct"), F.array_position(names, F.col("variable")))
            .select("variable", "type", (F.col("rows") - F.col("missing_count")).alias("non_missing_count"),
                    "missing_count", "unique_count", "missing_pct"))


def text_quality(df: DataFrame, cfg: Settings = DEFAULT, columns: list[str] | None = None) -> DataFrame:
    """Blanks, edge blanks, runs of blanks, line breaks, long texts and lengths per text column.

    Values are sanitised first. The white-space checks look at the raw text,
    because sanitising removes line breaks and tabs; as coded they look at the
    sanitised text.
    """
    columns = columns or text_columns(df)
    tall = with_clean_text(long_form(df, columns, [named(c) for c in columns], value="raw"))
    return text_quality_of(tall.groupBy("variable", bounded_key(F.col("clean")).alias("key")).agg(*text_counts(cfg)), columns)


def with_clean_text(tall: DataFrame) -> DataFrame:
    """Add ``care``, whether ``raw`` is other than plain text, and ``clean``, the sanitised text."""
    raw = F.col("raw")
    return tall.withColumn("care", needs_care(raw)).withColumn("clean", F.when(F.col("care"), sanitise(raw)).otherwise(raw))


def text_counts(cfg: Settings = DEFAULT, where: Column | None = None) -> list[Column]:
    """What ``text_quality`` counts, as aggregates over ``raw``, ``care`` and ``clean``."""
    where = F.lit(True) if where is None else where
    space = F.col("clean") if cfg.as_coded else F.col("raw")
    care = where & F.col("care")
    return [F.count_if(where & (F.col("clean") == "")).alias("blank_count"),
            F.count_if(care & has_edge_space(space)).alias("leading_trailing_space_count"),
            F.count_if(care & has_space_run(space)).alias("multiple_space_count"),
            F.count_if(care & has_line_break(space)).alias("newline_count"),
            F.count_if(where & (F.length("clean") > cfg.long_text)).alias("very_long_text_count"),
            F.max(F.when(where, F.length("clean"))).alias("max_text_length")]


def text_quality_of(per_value: DataFrame, columns: list[str]) -> DataFrame:
    """``text_quality`` from the counts of each distinct text of each column."""
    counts = ["blank_count", "leading_trailing_space_count", "multiple_space_count", "newline_count",
              "very_long_text_count"]
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("variable"))
    return (per_value.groupBy("variable")
            .agg(*[F.sum(c).alias(c) for c in counts], F.max("max_text_length").alias("max_text_length"),
                 F.count("*").alias("unique_count"))
            .orderBy(order))


def text_issues_only(quality: DataFrame) -> DataFrame:
    """Only the columns with at least one blank, white-space or line-break issue."""
    issues = ["blank_count", "leading_trailing_space_count", "multiple_space_count", "newline_count"]
    return quality.where(sum_all([F.col(c) for c in issues]) > 0).select("variable", *issues, "max_text_length")


def value_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., count``, largest first, ties by key."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *keys)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """``column, count`` of the non-NULL values."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count")).orderBy(column))


def level_summary(df: DataFrame, columns: list[str], n: int | None = None) -> DataFrame:
    """``variable, value, count``: the present values of each column, the most frequent first; with ``n`` so many of each."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "variable string, value string, count bigint")
    counts = (long_form(df, columns, [rendered(df, c) for c in columns])
              .where(is_present(F.col("value")))
              .groupBy("variable", "value").agg(F.count("*").alias("count")))
    return levels_of(counts, columns, n)


def levels_of(counts: DataFrame, columns: list[str], n: int | None = None) -> DataFrame:
    """``level_summary`` from its counts."""
    order = [F.desc("count"), F.asc("value")]
    if n is not None:
        counts = top_n_per_group(counts, "variable", order, n, slice_by="value")
    return counts.orderBy(F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("variable")), *order)


def level_columns(roles: Roles) -> list[str]:
    return [roles[r] for r in ("category", "color", "size", "material") if roles[r]]
