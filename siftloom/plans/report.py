"""The report over a diagnosed table: headline numbers, issue register, alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_timestamp
from ..functions.numbers import pct, pct_fixed
from ..functions.text import has_edge_space, has_line_break, is_present, needs_care, sanitise
from ..operators import checks, duplicates, ranges
from ..operators.roles import Roles, detect_roles, missing_in, text_columns
from ..operators.scale import sum_all
from ..settings import DEFAULT, Settings


# The labels of the price and discount checks behind each fact.
_PRICE_CHECKS = {
    "price_unparsed": "Price: could not be parsed", "price_negative": "Price: < 0", "price_zero": "Price: == 0",
    "discount_unparsed": "Discount: could not be parsed", "discount_over_100": "Discount: > 100",
    "discount_negative": "Discount: < 0",
}


def _row_local_facts(df: DataFrame, roles: Roles, cfg: Settings) -> DataFrame:
    """One row with everything that needs no distinct values: a single pass over the table."""
    columns = cfg.data_columns(df.columns)
    texts = text_columns(df)
    gaps = {c: F.coalesce(missing_in(df, c), F.lit(False)) for c in columns}
    prices = checks.price_discount_conditions(roles)

    def text_hits(check) -> Column:
        def hit(c: str) -> Column:
            value = sanitise(F.col(c)) if cfg.as_coded else F.col(c)
            return F.coalesce(needs_care(F.col(c)) & check(value), F.lit(False)).cast("int")
        return F.coalesce(F.sum(sum_all([F.lit(0), *map(hit, texts)])), F.lit(0))

    def count(condition: Column | None) -> Column:
        return F.lit(0).cast("long") if condition is None else F.count_if(condition)

    stamp = roles["scraped_at"]
    raw = F.col(stamp).cast("string") if stamp else None
    one = df.agg(
        F.count("*").alias("rows"),
        count(reduce(Column.__or__, gaps.values())).alias("rows_missing"),
        *[F.count_if(gap).alias(f"gap_{i}") for i, gap in enumerate(gaps.values())],
        *[count(prices.get(label)).alias(fact) for fact, label in _PRICE_CHECKS.items()],
        F.coalesce(F.sum(checks.invalid_url_count(df, roles, cfg)), F.lit(0)).alias("url_issues"),
        count(is_present(raw) & parse_timestamp(raw, cfg.date_orders).isNull() if stamp else None)
        .alias("timestamps_unparsed"),
        text_hits(has_edge_space).alias("edge_space"), text_hits(has_line_break).alias("line_breaks"),
        F.coalesce(F.sum(ranges.parse_failure_count(df, cfg)), F.lit(0)).alias("parse_failures"),
        count(None if cfg.as_coded or "images" not in df.columns else duplicates.repeats_element(F.col("images")))
        .alias("image_duplicates"))
    high = [(pct(F.col(f"gap_{i}"), F.col("rows")) >= cfg.high_missing_pct).cast("long") for i in range(len(columns))]
    return one.select(
        "rows", F.lit(len(columns)).alias("columns"), "rows_missing", *_PRICE_CHECKS, "url_issues",
        "timestamps_unparsed", F.lit(int(stamp is not None)).alias("timestamp_columns"), "edge_space", "line_breaks",
        F.coalesce(sum_all(high), F.lit(0)).alias("high_missing_columns"), "parse_failures", "image_duplicates")


def _tall(one: DataFrame) -> DataFrame:
    names = one.columns
    return one.select(*[F.col(n).cast("long").alias(n) for n in names]).unpivot([], names, "fact", "value")


def facts(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """``fact, value``: every count the report uses, from three passes over the table.

    Most facts are row-local and share one aggregate; repeated rows and repeated
    keys need a shuffle each. As coded the number of rows with repeated images is
    always 0, because the table it was taken from no longer exists.
    """
    roles = roles or detect_roles(df)
    keys = {fact: roles[role] for fact, role in (("duplicate_urls", "product_url"), ("duplicate_names", "product"))}
    known = list(dict.fromkeys(c for c in keys.values() if c))
    parts = [_tall(_row_local_facts(df, roles, cfg)),
             _tall(duplicates.exact_duplicate_count(df, cfg).withColumnRenamed("copies", "exact_duplicates"))]
    if known:
        copies = duplicates.key_duplicate_counts(df, known)
        parts.append(_tall(copies.agg(*[
            F.coalesce(F.max(F.when(F.col("variable") == F.lit(c), F.col("copies"))), F.lit(0)).alias(fact)
            for fact, c in keys.items()])))
    return reduce(DataFrame.unionByName, parts)


def _wide_facts(df: DataFrame, roles: Roles | None, cfg: Settings, names: list[str]) -> DataFrame:
    f = facts(df, roles, cfg)
    return f.agg(*[F.max(F.when(F.col("fact") == n, F.col("value"))).alias(n) for n in names])


def executive_metrics(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """One row: rows, columns, exact duplicates, rows with gaps, price anomalies, image duplicates, shares."""
    wide = _wide_facts(df, roles, cfg, ["rows", "columns", "exact_duplicates", "rows_missing", "price_unparsed",
                                        "price_negative", "price_zero", "image_duplicates"])
    width = F.col("columns") - (1 if cfg.as_coded else 0)
    anomalies = F.col("price_unparsed") + F.col("price_negative") + F.col("price_zero")
    return wide.select(
        F.col("rows").alias("total_rows"), width.alias("total_columns"), "exact_duplicates",
        pct_fixed(F.col("exact_duplicates"), F.col("rows")).alias("exact_duplicates_pct"),
        "rows_missing", pct_fixed(F.col("rows_missing"), F.col("rows")).alias("rows_missing_pct"),
        anomalies.alias("price_anomalies"), F.col("image_duplicates").alias("image_dup_records"),
        pct(F.col("image_duplicates"), F.col("rows"), 1).alias("image_dup_pct"))


# The register's ids, categories, descriptions and priorities. "{n}" stands for the count.
REGISTER = (
    ("S1", "Structure", "Exact duplicate rows", "exact_duplicates", "High", "Drop exact copies, keep the first row"),
    ("S2", "Missingness", "{n} column(s) exceed 30% missing", "high_missing_columns", "Medium",
     "Decide per column: impute, exclude or document"),
    ("D1", "Duplicates", "Duplicate product URLs — multi-date scraping", "duplicate_urls", "High",
     "Keep the latest scrape per product URL"),
    ("D2", "Duplicates", "Duplicate product names", "duplicate_names", "Medium",
     "Tell real variants from scraping copies"),
    ("D3", "Duplicates", "Duplicate image URLs within product rows", "image_duplicates", "Medium",
     "Keep each image URL once per row"),
    ("P1", "Price", "Price values that could not be parsed", "price_unparsed", "High",
     "Strip marks and parse; NULL when hopeless"),
    ("P2", "Price", "Prices equal to zero", "price_zero", "Medium", "Settle: free item or missing price"),
    ("P3", "Price", "Prices that are negative", "price_negative", "High", "Set NULL and report to the source"),
    ("P4", "Discount", "Discounts exceeding 100%", "discount_over_100", "High", "Cap at 100 and flag"),
    ("U1", "URLs", "URLs not starting with http(s)://", "url_issues", "Medium", "Repair the prefix, else drop"),
    ("T1", "Text", "Leading / trailing whitespace", "edge_space", "Low", "Squish every text column"),
    ("T2", "Text", "Embedded newline characters", "line_breaks", "Low", "Turn line breaks into blanks"),
    ("DT1", "Timestamps", "Timestamp parsing failures", "timestamps_unparsed", "Medium", "Add date orders"),
    ("I1", "Images", "Multi-date scrape without deduplication", "image_duplicates", "High",
     "Treat the latest scrape per URL as the product"),
)


def issue_register(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """``id, category, description, affected, priority, action``: fourteen rows in a fixed order."""
    entries = df.sparkSession.createDataFrame(
        [(i, *row) for i, row in enumerate(REGISTER)],
        "ordinal int, id string, category string, description string, fact string, priority string, action string")
    # The register has fourteen rows, so it is the side to broadcast.
    joined = facts(df, roles, cfg).join(F.broadcast(entries), "fact")
    text = F.replace("description", F.lit("{n}"), F.col("value").cast("string"))
    return joined.orderBy("ordinal").select(
        "id", "category", text.alias("description"), F.col("value").alias("affected"), "priority", "action")


# Fixed values: (rule, fact, severity when the count is positive, severity when it is zero).
ALERT_RULES = (
    ("exact_duplicates", "exact_duplicates", "high", None),
    ("duplicate_urls", "duplicate_urls", "high", None),
    ("image_duplicates", "image_duplicates", "medium", "medium"),
    ("high_missing_columns", "high_missing_columns", "medium", "low"),
    ("parse_failures", "parse_failures", "medium", "low"),
    ("price_unparsed", "price_unparsed", "high", None),
    ("price_negative", "price_negative", "high", None),
    ("price_zero", "price_zero", "high", None),
    ("discount_unparsed", "discount_unparsed", "high", None),
    ("discount_over_100", "discount_over_100", "high", None),
    ("discount_negative", "discount_negative", "high", None),
    ("no_price_or_discount_issue", "price_discount_issues", None, "low"),
    ("url_issues", "url_issues", "medium", "low"),
    ("timestamps_unparsed", "timestamps_unparsed", "medium", None),
    ("all_timestamps_parsed", "timestamps_state", "info", None),
    ("no_timestamp_column", "timestamp_columns", None, "medium"),
    ("edge_space", "edge_space", "low", None),
    ("line_breaks", "line_breaks", "low", None),
)
_PRICE_FACTS = ["price_unparsed", "price_negative", "price_zero", "discount_unparsed", "discount_over_100",
                "discount_negative"]


def alerts(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """``rule, severity, affected``: the rules that fire on this table."""
    names = sorted({fact for _, fact, _, _ in ALERT_RULES} - {"price_discount_issues", "timestamps_state"})
    wide = _wide_facts(df, roles, cfg, names)
    all_parsed = (F.col("timestamp_columns") > 0) & (F.col("timestamps_unparsed") == 0)
    wide = wide.withColumn("price_discount_issues", reduce(lambda a, b: a + b, [F.col(n) for n in _PRICE_FACTS]))
    wide = wide.withColumn("timestamps_state", all_parsed.cast("long"))
    fired = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(rule).alias("rule"),
                 F.when(F.col(fact) > 0, F.lit(positive)).otherwise(F.lit(zero)).cast("string").alias("severity"),
                 F.col(fact).alias("affected"))
        for i, (rule, fact, positive, zero) in enumerate(ALERT_RULES)])
    return (wide.select(F.inline(fired)).where(F.col("severity").isNotNull())
            .orderBy("ordinal").select("rule", "severity", "affected"))
