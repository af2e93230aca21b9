"""Duplicate detection and removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lists import has_repeats, list_elements
from ..functions.numbers import pct_text
from ..functions.text import bounded_key, free_name, is_present, named, rendered, row_digest
from ..settings import DEFAULT, Settings
from .roles import Roles, missing_in
from .scale import (
    first_per_key, first_selected_rows, long_form, row_identity, rows_that_may_repeat, rows_with_listed_key, wide_to_rows,
)


def exact_duplicate_count(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """One row, ``copies``: how many rows repeat an earlier row."""
    groups = df.groupBy(*row_identity(df, cfg.data_columns(df.columns))).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))


def key_duplicate_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``variable, present, copies``: present values and how many repeat an earlier one.

    Counts per value are formed before the shuffle, so a value that fills a
    third of the column costs one row per task.
    """
    tall = long_form(df, columns, [rendered(df, c) for c in columns]).where(is_present(F.col("value")))
    return key_copies_of(tall.groupBy("variable", bounded_key(F.col("value")).alias("key")).agg(F.count("*").alias("n")))


def key_copies_of(per_value: DataFrame) -> DataFrame:
    """``key_duplicate_counts`` from how often each present value occurs."""
    return per_value.groupBy("variable").agg(F.sum("n").alias("present"), F.sum(F.col("n") - 1).alias("copies"))


_KEY_CHECKS = (
    ("Duplicate product URLs", "product_url"),
    ("Duplicate product names", "product"),
    ("Duplicate image URLs", "image_url"),
)


def duplicate_summary(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT) -> DataFrame:
    """``check, count`` for exact rows, URLs, names and image URLs; NULL where the role is absent."""
    known = [roles[role] for _, role in _KEY_CHECKS if roles[role]]
    counts = key_duplicate_counts(df, list(dict.fromkeys(known))) if known else None
    return duplicate_summary_of(exact_duplicate_count(df, cfg), counts, roles)


def summary_columns(roles: Roles) -> list[str]:
    """The key columns that the summary counts."""
    return list(dict.fromkeys(roles[role] for _, role in _KEY_CHECKS if roles[role]))


def duplicate_summary_of(copies: DataFrame, counts: DataFrame | None, roles: Roles) -> DataFrame:
    """``duplicate_summary`` from the number of exact copies and those of each key column."""
    known = summary_columns(roles)
    exact = copies.select(F.lit("Exact duplicate rows").alias("check"), F.col("copies").alias("count"))
    if known:
        wide = counts.agg(*[F.max(F.when(F.col("variable") == c, F.col("copies"))).alias(c) for c in dict.fromkeys(known)])
    else:
        wide = exact.agg(F.count("*"))
    rows = [[F.lit(label), F.coalesce(F.col(f"`{roles[role]}`"), F.lit(0)) if roles[role] else F.lit(None).cast("long")]
            for label, role in _KEY_CHECKS]
    return exact.unionByName(wide_to_rows(wide, rows, ["check", "count"]))


def exact_duplicate_rows(df: DataFrame, cfg: Settings = DEFAULT, n: int | None = None) -> DataFrame:
    """All copies of rows that occur more than once; with ``n`` the first ``n`` by row id, in that order."""
    return _repeated_rows(df, row_digest(df, cfg.data_columns(df.columns)), cfg, n)


def repeated_key_rows(df: DataFrame, key: str, cfg: Settings = DEFAULT, n: int | None = None) -> DataFrame:
    """All rows whose present ``key`` occurs more than once; with ``n`` the first ``n`` by row id, in that order."""
    return _repeated_rows(df.where(~missing_in(df, key)), bounded_key(rendered(df, key)), cfg, n)


def _repeated_rows(df: DataFrame, key: Column, cfg: Settings, n: int | None) -> DataFrame:
    """One aggregate over the keys and one semi-join, both of rows only whose key's hash occurs twice; with ``n`` only ids
    travel until the first are known."""
    name = free_name(df.columns, "__key")
    keyed = rows_that_may_repeat(df, key).withColumn(name, key) if n is None else df.select(cfg.row_id, key.alias(name))
    repeated = keyed.select(name).groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    selected = rows_with_listed_key(keyed, repeated, name, "n", cfg.row_id)
    return selected.drop(name) if n is None else first_selected_rows(df, selected, n, cfg.row_id)


def repeats_element(c: Column) -> Column:
    """Whether a serialised list names an element twice; never NULL."""
    return F.coalesce(is_present(c) & has_repeats(list_elements(c)), F.lit(False))


def repeated_element_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose serialised list names an element twice."""
    return df.where(repeats_element(F.col(column)))


def image_dup_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: ``records`` with a repeated list element, and all ``rows``."""
    return df.agg(F.count_if(repeats_element(F.col(column))).alias("records"), F.count("*").alias("rows"))


def image_dup_summary(df: DataFrame, column: str = "images") -> DataFrame:
    """``metric, value`` (texts): records with a repeated image URL, as number and share; empty without the column."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], "metric string, value string")
    return image_dup_table(image_dup_counts(df, column))


def image_dup_table(counts: DataFrame) -> DataFrame:
    """``image_dup_summary`` from ``records`` and ``rows``."""
    return wide_to_rows(counts, [
        [F.lit("Records with at least one duplicate image URL"), F.col("records").cast("string")],
        [F.lit("Pct of total records"), pct_text(F.col("records"), F.col("rows"))],
    ], ["metric", "value"])


def keep_first_per_key(df: DataFrame, key: str, cfg: Settings = DEFAULT) -> DataFrame:
    """First row, by row id, of every key. Rows whose key is NULL or blank all stay; as coded NULL and '' are keys."""
    order = F.col(cfg.row_id)
    if cfg.as_coded:
        return first_per_key(df, [key], order)
    # Rows without a key get one of their own: one scan, and they spread over all tasks.
    own = F.concat(F.lit("row:"), F.col(cfg.row_id).cast("string"))
    name = free_name(df.columns, "__key")
    keyed = df.withColumn(name, F.when(~missing_in(df, key), F.concat(F.lit("key:"), named(key).cast("string"))).otherwise(own))
    return first_per_key(keyed, [name], order).select(*[named(c) for c in df.columns])


def keep_first_counted(df: DataFrame, key: str, copies: str, cfg: Settings = DEFAULT) -> DataFrame:
    """``keep_first_per_key`` with a column ``copies``: how many rows each row that stays stands for."""
    name, order = free_name(df.columns, "__key"), F.col(cfg.row_id)
    own = F.concat(F.lit("row:"), F.col(cfg.row_id).cast("string"))
    value = named(key) if cfg.as_coded else F.when(~missing_in(df, key), F.concat(F.lit("key:"), named(key).cast("string"))).otherwise(own)
    first = df.groupBy(value.alias(name)).agg(F.min_by(F.struct(*[named(c) for c in df.columns]), order).alias("__row"), F.count("*").alias(copies))
    return first.select("__row.*", copies)


def drop_exact_duplicates(df: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """One row, the first, of every set of equal rows."""
    columns = df.columns
    data = [c for c in columns if c != cfg.row_id]
    name = free_name(columns, "__digest")
    tagged = df.withColumn(name, row_digest(df, data))
    return first_per_key(tagged, [name], F.col(cfg.row_id)).select(*[named(c) for c in columns])
