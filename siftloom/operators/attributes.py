"""Key/value attributes and list elements taken out of serialised texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.lists import key_value_pairs, list_elements
from ..functions.text import is_present, squish
from ..settings import DEFAULT, Settings
from .profile import value_counts


def attribute_pairs(df: DataFrame, column: str = "description", cfg: Settings = DEFAULT) -> DataFrame:
    """``row_number, attribute_name, attribute_value``: one row per pair, white space squished."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"{cfg.row_id} bigint, attribute_name string, attribute_value string")
    pairs = df.where(is_present(F.col(column))).select(cfg.row_id, F.inline(key_value_pairs(F.col(column))))
    return pairs.select(cfg.row_id, squish(F.col("attribute_name")).alias("attribute_name"),
                        squish(F.col("attribute_value")).alias("attribute_value"))


def attribute_counts(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., count`` over pairs whose keys are all present, largest first."""
    for key in keys:
        pairs = pairs.where(is_present(F.col(key)))
    return value_counts(pairs, keys)


def list_items(df: DataFrame, column: str = "images", cfg: Settings = DEFAULT) -> DataFrame:
    """``row_number, <column>``: one row per non-blank list element."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"{cfg.row_id} bigint, {column} string")
    items = df.where(is_present(F.col(column))).select(cfg.row_id, F.explode(list_elements(F.col(column))).alias(column))
    return items.where(is_present(F.col(column)))


def list_item_counts(df: DataFrame, column: str = "images", cfg: Settings = DEFAULT) -> DataFrame:
    return value_counts(list_items(df, column, cfg), [column])
