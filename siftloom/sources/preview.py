"""A first look at a table: leading rows, column types, per-column summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ranges import range_checks
from ..operators.roles import numeric_columns
from ..operators.scale import first_rows, wide_to_rows
from ..settings import DEFAULT, Settings


def head(df: DataFrame, n: int = 3, cfg: Settings = DEFAULT) -> DataFrame:
    return first_rows(df, n, cfg.row_id)


def column_summary(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """``variable, type, length, nulls`` and, for numbers, ``min, q1, median, mean, q3, max``."""
    columns = cfg.data_columns(df.columns)
    totals = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}")
                                                 for i, c in enumerate(columns)])
    types = dict(df.dtypes)
    base = wide_to_rows(totals, [[F.lit(i), F.lit(c), F.lit(types[c]), F.col("rows"), F.col(f"n{i}")]
                                 for i, c in enumerate(columns)], ["ordinal", "variable", "type", "length", "nulls"])
    numbers = [c for c in numeric_columns(df) if c in columns]
    stats = ["min", "q1", "median", "mean", "q3", "max"]
    if numbers:
        base = base.join(range_checks(df, cfg, numbers).select("variable", *stats), "variable", "left")
    else:
        base = base.select("*", *[F.lit(None).cast("double").alias(s) for s in stats])
    return base.orderBy("ordinal").select("variable", "type", "length", "nulls", *stats)


def preview(df: DataFrame, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
    return {"head": head(df, cfg=cfg), "summary": column_summary(df, cfg)}
