"""The whole cleaner: raw catalogue in, one wide row per product out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.text import free_name, named
from ..operators import cleaning as C
from ..operators.duplicates import keep_first_counted
from ..operators.profile import distribution, missing_summary, missingness_by_variable
from ..operators.ranges import range_checks
from ..operators.roles import Roles, detect_roles, present_rows, priority_first
from ..operators.scale import wide_to_rows
from ..operators.sizes import SIZE_RULES, SizeRule
from ..settings import DEFAULT, Settings

# Leading columns of the cleaned table, in order.
PRIORITY = [
    "sku", "url", "name", "price", "price_flag", "brand", "color",
    "size_system", "size_count", "size_labels", "size_us", "size_eu",
    "dimensions_raw", "waist", "inseam", "has_petite", "has_tall", "has_plus",
    "images_n", "images_clean",
]


@dataclass(frozen=True)
class Cleaned:
    """The cleaned table and the log of replaced and dropped columns."""

    table: DataFrame
    log: list[C.LogEntry]
    source: DataFrame | None = None

    def log_table(self) -> DataFrame:
        """``column, action, reason``, and ``present_rows`` of the raw column where the raw table is known."""
        rows = [(e.column, e.action, e.reason) for e in self.log]
        table = self.table.sparkSession.createDataFrame(rows, "column string, action string, reason string")
        return table if self.source is None else present_rows(self.source, table, "column")

    def statistics(self, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
        """The summaries, and missing shares and numeric ranges of the cleaned table.

        These read the table several times: write it first and pass the stored copy on.
        """
        return {**self.summaries(), "missingness": missingness_by_variable(self.table, cfg),
                "ranges": range_checks(self.table, cfg)}

    def summaries(self) -> dict[str, DataFrame]:
        tables = {"missing_summary": missing_summary(self.table)}
        for column in ("size_system", "price_flag"):
            if column in self.table.columns:
                tables[f"{column}_distribution"] = distribution(self.table, column)
        return tables


def clean_rows(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT, rules: tuple[SizeRule, ...] = SIZE_RULES,
               color_one_space: bool = False, raw_images: bool = False) -> Cleaned:
    """All row-local steps; they neither shuffle nor keep state, so a streaming table works too."""
    log: list[C.LogEntry] = []
    steps = [
        lambda d: C.clean_price(d, roles["price"], cfg),
        C.clean_brand,
        lambda d: C.extract_color(d, one_space=color_one_space),
        lambda d: C.clean_size(d, rules=rules),
        lambda d: (d, []) if raw_images else C.clean_images(d, cfg=cfg),
    ]
    for step in steps:
        df, entries = step(df)
        log += entries
    return Cleaned(priority_first(df, PRIORITY), log)


def clean(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT, **options) -> Cleaned:
    """First row per SKU, then all row-local steps. The SKU step is the only shuffle."""
    roles = roles or detect_roles(df)
    deduplicated, _ = C.clean_sku(df, cfg)
    return replace(clean_rows(deduplicated, roles, cfg, **options), source=df)


_COUNTERS = ("rows_before_dedup", "rows_after_dedup", "duplicate_rows_removed", "price_issues", "brands_set_null", "color_found", "color_missing")


def write_counted(df: DataFrame, folder: str, roles: Roles | None = None, cfg: Settings = DEFAULT, **options) -> DataFrame:
    """Clean, write the table as Parquet to ``folder``, and return ``run_counters`` taken on that one job.

    All counters are observed behind the SKU step's shuffle, where each row knows how many it stands for. Tasks of the last
    stage report once each, so stages that are run again after a loss count nothing twice; the source is scanned once.
    """
    roles = roles or detect_roles(df)
    copies = free_name([*df.columns, *PRIORITY], "__copies")
    first = keep_first_counted(C.clean_sku_text(df), "sku", copies, cfg) if "sku" in df.columns else df.withColumn(copies, F.lit(1).cast("bigint"))
    table = clean_rows(first, roles, cfg, **options).table
    seen = Observation()
    there = {c: named(c) if c in table.columns else F.lit(None) for c in ("price_flag", "brand", "color")}
    counted = table.observe(
        seen, F.coalesce(F.sum(copies), F.lit(0)).alias("before"), F.count(F.lit(1)).alias("after"), F.count_if(there["price_flag"] != "ok").alias("price"),
        F.count_if(there["brand"].isNull()).alias("brand"), F.count(there["color"]).alias("color"))
    counted.drop(copies).write.mode("overwrite").parquet(folder)
    m = seen.get
    values = (m["before"], m["after"], m["before"] - m["after"], m["price"], m["brand"], m["color"], m["after"] - m["color"])
    return df.sparkSession.createDataFrame(list(zip(_COUNTERS, values)), "counter string, value bigint")


def run_counters(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """``counter, value``: rows before and after the SKU step, price issues, brands and colours.

    Everything is read off one aggregate over the cleaned rows; the number of
    rows before comes from a scan without columns.
    """
    roles = roles or detect_roles(df)
    table = clean(df, roles, cfg).table
    totals = table.agg(
        F.count("*").alias("after"), F.count_if(F.col("price_flag") != "ok").alias("price_issues"),
        F.count_if(F.col("brand").isNull()).alias("brands_null"), F.count("color").alias("color_found"),
        F.count_if(F.col("color").isNull()).alias("color_missing"))
    before = df.agg(F.count("*").alias("before")).scalar()
    totals = totals.withColumn("before", before)
    values = [F.col("before"), F.col("after"), F.col("before") - F.col("after"), F.col("price_issues"),
              F.col("brands_null"), F.col("color_found"), F.col("color_missing")]
    return wide_to_rows(totals, [[F.lit(n), v] for n, v in zip(_COUNTERS, values)], ["counter", "value"])
