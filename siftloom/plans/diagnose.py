"""The diagnostics run: twenty named tables over one raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import attributes, checks, duplicates, profile, ranges
from ..operators.roles import LOOSE_PATTERNS, Roles, detect_roles, detected_columns
from ..settings import DEFAULT, Settings


def diagnose(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
    """``{name: table}``; nothing runs until a table is read or written.

    Every table reads only the columns it needs from the source, so the source
    should be Parquet; a cached copy of a table of this size would not pay.
    """
    roles = roles or detect_roles(df)
    pairs = attributes.attribute_pairs(df, cfg=cfg)
    tables = {
        "overview": profile.overview(df, cfg),
        "detected_columns": detected_columns(df, roles),
        "variable_types": profile.variable_types(df, cfg),
        "missingness_by_variable": profile.missingness_by_variable(df, cfg),
        "missingness_by_row": profile.missingness_by_row(df, cfg),
        "duplicate_summary": duplicates.duplicate_summary(df, roles, cfg),
        "exact_dup_rows": duplicates.exact_duplicate_rows(df, cfg),
        "dup_url_rows": (duplicates.repeated_key_rows(df, roles["product_url"], cfg)
                         if roles["product_url"] else df.limit(0)),
        "image_dup_summary": duplicates.image_dup_summary(df),
        "range_checks": ranges.range_checks(df, cfg),
        "numeric_parse_issues": ranges.numeric_parse_issues(df, cfg),
        "price_discount_checks": checks.price_discount_checks(df, roles),
        "url_checks": checks.url_checks(df, roles, cfg),
        "datetime_checks": checks.datetime_checks(df, roles, cfg),
        "text_quality": profile.text_quality(df, cfg),
        "level_summary": profile.level_summary(df, profile.level_columns(roles)),
        "attr_names": attributes.attribute_counts(pairs, ["attribute_name"]),
        "attr_values": attributes.attribute_counts(pairs, ["attribute_value"]),
        "attr_name_values": attributes.attribute_counts(pairs, ["attribute_name", "attribute_value"]),
        "problem_rows": checks.problem_rows(df, roles, cfg),
    }
    return tables


def diagnose_loose(df: DataFrame, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The nineteen tables of the older run: looser column names, no image summary."""
    tables = diagnose(df, detect_roles(df, LOOSE_PATTERNS), cfg)
    del tables["image_dup_summary"]
    return tables
