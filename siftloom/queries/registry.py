"""Every operator as a named query over the test tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..catalog.view import catalog, read_table
from ..functions import dates, lists, numbers, text
from ..operators import attributes, checks, cleaning, duplicates, extensions, profile, ranges, sizes, sketches
from ..operators.roles import LOOSE_PATTERNS, detect_roles, detected_columns
from ..plans import bundle, clean as clean_plan, prepare, report
from ..session import tune
from ..settings import CODED, DEFAULT, Settings
from ..sources import preview, tables
from ..sources.identity import number_rows, pin
from ..sources.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]

# Native tables have no row number; their keys give the order.
_DOCS = Settings(row_id="doc_id")
# Tables whose key is not unique, or is itself to be profiled: every column is data.
_NONE = Settings(row_id="__none")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show; means that are exact ties, as of decimals, go up."""
    up = {"mean": 1 + 1e-12}
    return df.select(*[F.round(F.col(f.name) * F.lit(up.get(f.name, 1.0)), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema])


def _catalog(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(catalog(tune(spark), folder))


def _native(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(read_table(tune(spark), folder, table))


def _roles(df: DataFrame):
    return detect_roles(df)


def _cleaned(df: DataFrame, cfg: Settings = DEFAULT, **options) -> DataFrame:
    return clean_plan.clean(df, _roles(df), cfg, **options).table


def _price(cfg: Settings) -> Callable[[DataFrame], DataFrame]:
    return lambda df: cleaning.clean_price(df, "price", cfg)[0].select("row_number", "price", "price_flag")


def _images(cfg: Settings) -> Callable[[DataFrame], DataFrame]:
    return lambda df: cleaning.clean_images(df, "images", cfg)[0].select("row_number", "images_clean", "images_n")


def _blank_skus(df: DataFrame) -> DataFrame:
    """The catalogue with some SKUs blank, and some blank once their prefix is off."""
    blank = F.when(F.col("row_number") % 11 == 0, "").when(F.col("row_number") % 13 == 0, "SKU: ").otherwise(F.col("sku"))
    return df.withColumn("sku", blank)


def _imputed(df: DataFrame) -> DataFrame:
    wanted = ["row_number", "size_system", "price", "brand", "color"]
    filled = extensions.impute_by_group(_cleaned(df).select(*wanted), "size_system", ["price", "brand", "color"])
    return rounded(filled.select("row_number", "size_system", "price", "price_imputed", "brand", "brand_imputed",
                                 "color", "color_imputed"))


def _imputed_levels(df: DataFrame) -> DataFrame:
    """Prices and colours by size system and brand, then size system, then all."""
    wanted = ["row_number", "size_system", "brand", "price", "color"]
    filled = extensions.impute_by_levels(_cleaned(df).select(*wanted), [["size_system", "brand"], ["size_system"], []], ["price", "color"])
    return rounded(filled.select("row_number", "price", "price_imputed", "price_imputed_from", "color", "color_imputed_from"))


def _post_clean_ranges(df: DataFrame) -> DataFrame:
    return rounded(ranges.range_checks(_cleaned(df)))


def _prepared(df: DataFrame) -> DataFrame:
    return prepare.prepare(df).table


def _number_formats(df: DataFrame) -> DataFrame:
    present = F.count_if(text.is_present(F.col("price")))
    return df.groupBy("size").agg(F.count("*").alias("n"), present.alias("present")).select(
        "size", numbers.thousands(F.col("n") * 1000).alias("n_text"),
        numbers.pct_fixed(F.col("present"), F.col("n") * 3).alias("present_text"))


def _csv_orders(df: DataFrame) -> DataFrame:
    """The orders with a text that holds quotes, commas and line ends."""
    note = F.concat(F.lit('say "hi", '), F.col("o_orderpriority"), F.lit("\nline "), F.col("o_orderstatus"))
    return df.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, note).alias("note"), "o_orderpriority")


def _clean_csv(df: DataFrame) -> DataFrame:
    """The orders as clean CSV and back by Spark's own reader."""
    folder = new_folder(df.sparkSession)
    tables.write_clean_csv(_csv_orders(df), folder)
    return df.sparkSession.read.options(header=True, multiLine=True, quote='"', escape='"').schema(_csv_orders(df).schema).csv(folder)


def _landed_csv(df: DataFrame) -> DataFrame:
    """The orders as CSV, landed with types and row numbers."""
    spark, source, target = df.sparkSession, new_folder(df.sparkSession), new_folder(df.sparkSession)
    tables.write_clean_csv(_csv_orders(df), source)
    landed = tables.infer_types(tables.validated(tables.land_csv(spark, source, target)))
    return landed.select("o_orderkey", "o_custkey", "note", "o_orderpriority").withColumn("numbers", F.lit(_dense(landed)))


def _dense(df: DataFrame) -> bool:
    n, low, high, kinds = df.agg(F.count("*"), F.min("row_number"), F.max("row_number"), F.count_distinct("row_number")).first()
    return n == 0 or (low, high, kinds) == (1, n, n)


def _bundle(df: DataFrame) -> dict[str, DataFrame]:
    """The stored run, written as a bundle and read back."""
    found = bundle.diagnose_stored(df, _roles(df))
    folder = new_folder(df.sparkSession)
    tables.write_bundle(found, folder)
    return tables.read_bundle(df.sparkSession, folder, list(found))


def _bundle_counts(df: DataFrame) -> DataFrame:
    counts = [t.agg(F.count("*").alias("records")).select(F.lit(name).alias("name"), "records") for name, t in _bundle(df).items()]
    return reduce(DataFrame.unionByName, counts)


def _counted_write(df: DataFrame) -> DataFrame:
    return clean_plan.write_counted(df, new_folder(df.sparkSession), _roles(df))


def _elected(df: DataFrame) -> DataFrame:
    """Order dates as day/month texts, most of them ambiguous, read by the order that the column elects."""
    text_ = df.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    cfg = checks.elected_orders(text_, "day")
    return text_.select("o_orderkey", dates.timestamp_text(dates.parse_timestamp(F.col("day"), cfg.date_orders)).alias("day"))


def _by_status(df: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sketches of the three parts of the orders, stored side by side."""
    parts = [build(df.where(F.col("o_orderstatus") == s)) for s in ("F", "O", "P")]
    return pin(reduce(DataFrame.unionByName, parts))


def _sketched_ranges(df: DataFrame) -> DataFrame:
    """Exact figures of the merged sketches, and whether the median's rank is as near to the middle as the sketch promises."""
    found = sketches.range_checks_from(_by_status(df, lambda p: sketches.range_sketches(p, columns=["o_totalprice", "o_custkey"])))
    middle = {r["variable"]: r["median"] for r in found.select("variable", "median").collect()}
    ranks = df.agg(*[(F.count_if(F.col(c) <= m) / F.count(c)).alias(c) for c, m in middle.items()], *[
        (F.count_if(F.col(c) < m) / F.count(c)).alias(f"{c}_below") for c, m in middle.items()]).first()
    near = {c: ranks[f"{c}_below"] - sketches.KLL_RANK_ERROR <= 0.5 <= ranks[c] + sketches.KLL_RANK_ERROR for c in middle}
    return rounded(found.select("variable", "parsed_count", "min", "max", "mean", "negative_count", "zero_count")
                   .withColumn("median_near", F.element_at(F.create_map(*[F.lit(x) for kv in near.items() for x in kv]), F.col("variable"))))


def _sketched_distinct(df: DataFrame) -> DataFrame:
    """Merged distinct counts of the parts beside the exact ones' bounds."""
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    found = sketches.distinct_from(_by_status(df, lambda p: sketches.distinct_sketches(p, columns)))
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    pairs = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("exact")) for c in columns])))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= 5 * sketches.THETA_ERROR * F.col("exact")
    return found.join(F.broadcast(pairs), "variable").select("variable", "present", "exact", near.alias("near"))


def _sketched_overlap(df: DataFrame) -> DataFrame:
    """Customers of finished and of open orders, and of both."""
    one, other = (sketches.distinct_sketches(df.where(F.col("o_orderstatus") == s), ["o_custkey"]) for s in ("F", "O"))
    exact = df.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_orderstatus") == "O").alias("o")).agg(
        F.count_if("f").alias("exact_one"), F.count_if("o").alias("exact_other"), F.count_if(F.col("f") & F.col("o")).alias("exact_both"))
    near = [F.abs(F.col(c) - F.col(f"exact_{c}")) <= 10 * sketches.THETA_ERROR * F.col("exact_both") + 1 for c in ("one", "other", "both")]
    return sketches.overlap(one, other).join(F.broadcast(exact)).select("variable", "exact_one", "exact_other", "exact_both", (near[0] & near[1] & near[2]).alias("near"))


def _attr(keys: list[str]) -> Query:
    return _catalog(lambda df: attributes.attribute_counts(attributes.attribute_pairs(df), keys))


def queries() -> dict[str, Query]:
    return {
        # Diagnostics over the catalogue.
        "overview": _catalog(profile.overview),
        "overview_as_coded": _catalog(lambda df: profile.overview(df, CODED)),
        "detected_columns": _catalog(lambda df: detected_columns(df, _roles(df))),
        "detected_columns_loose": _catalog(lambda df: detected_columns(df, detect_roles(df, LOOSE_PATTERNS))),
        "variable_types": _catalog(profile.variable_types),
        "variable_types_as_coded": _catalog(lambda df: profile.variable_types(df, CODED)),
        "missingness_by_variable": _catalog(profile.missingness_by_variable),
        "missingness_by_variable_as_coded": _catalog(lambda df: profile.missingness_by_variable(df, CODED)),
        "high_missing_columns": _catalog(lambda df: profile.high_missing_columns(profile.missingness_by_variable(df))),
        "missingness_by_row": _catalog(profile.missingness_by_row),
        "duplicate_summary": _catalog(lambda df: duplicates.duplicate_summary(df, _roles(df))),
        "duplicate_summary_as_coded": _catalog(lambda df: duplicates.duplicate_summary(df, _roles(df), CODED)),
        "exact_dup_rows": _catalog(duplicates.exact_duplicate_rows),
        "exact_dup_rows_top50": _catalog(lambda df: duplicates.exact_duplicate_rows(df, n=50)),
        "dup_url_rows_top50": _catalog(lambda df: duplicates.repeated_key_rows(df, "url", n=50)),
        "dup_url_rows": _catalog(lambda df: duplicates.repeated_key_rows(df, "url")),
        "image_dup_summary": _catalog(duplicates.image_dup_summary),
        "image_dup_rows": _catalog(lambda df: duplicates.repeated_element_rows(df, "images").select("row_number", "images")),
        "image_url_counts": _catalog(attributes.list_item_counts),
        "range_checks": _catalog(lambda df: rounded(ranges.range_checks(df))),
        "range_checks_as_coded": _catalog(lambda df: rounded(ranges.range_checks(df, CODED))),
        "numeric_parse_issues": _catalog(ranges.numeric_parse_issues),
        "price_discount_checks": _catalog(lambda df: checks.price_discount_checks(df, _roles(df))),
        "url_checks": _catalog(lambda df: checks.url_checks(df, _roles(df))),
        "url_checks_as_coded": _catalog(lambda df: checks.url_checks(df, _roles(df), CODED)),
        "url_checks_loose": _catalog(lambda df: checks.url_checks(df, detect_roles(df, LOOSE_PATTERNS), CODED)),
        "datetime_checks": _catalog(lambda df: checks.datetime_checks(df, _roles(df))),
        "text_quality": _catalog(profile.text_quality),
        "text_quality_as_coded": _catalog(lambda df: profile.text_quality(df, CODED)),
        "text_issue_columns": _catalog(lambda df: profile.text_issues_only(profile.text_quality(df))),
        "level_summary": _catalog(lambda df: profile.level_summary(df, profile.level_columns(_roles(df)))),
        "level_summary_top50": _catalog(lambda df: profile.level_summary(df, ["size", "description"], 50)),
        "attribute_pairs": _catalog(attributes.attribute_pairs),
        "attr_names": _attr(["attribute_name"]),
        "attr_values": _attr(["attribute_value"]),
        "attr_name_values": _attr(["attribute_name", "attribute_value"]),
        "issue_flags": _catalog(lambda df: checks.issue_flags(df, _roles(df))),
        "issue_flags_loose": _catalog(lambda df: checks.issue_flags(df, detect_roles(df, LOOSE_PATTERNS))),
        "problem_rows": _catalog(lambda df: checks.problem_rows(df, _roles(df))),
        "problem_rows_top100": _catalog(lambda df: checks.problem_rows(df, _roles(df), n=100)),
        "image_scrape_dates": _catalog(extensions.image_scrape_dates),
        # Report.
        "issue_register": _catalog(report.issue_register),
        "issue_register_as_coded": _catalog(lambda df: report.issue_register(df, cfg=CODED)),
        "executive_metrics": _catalog(report.executive_metrics),
        "executive_metrics_as_coded": _catalog(lambda df: report.executive_metrics(df, cfg=CODED)),
        "alerts": _catalog(report.alerts),
        "report_facts": _catalog(report.facts),
        # Sources and previews.
        "preview_head": _catalog(preview.head),
        "column_summary_lineitem": _native("lineitem", lambda df: rounded(preview.column_summary(df, _NONE))),
        "sample_extract": _catalog(tables.sample_extract),
        "sample_extract_top1000": _catalog(lambda df: tables.sample_extract(df, 1000)),
        "row_identity_orders": _native("orders", lambda df: number_rows(df).select("row_number", "o_orderkey")),
        "csv_landed_orders": _native("orders", _landed_csv),
        "csv_clean_orders": _native("orders", _clean_csv),
        # The run in four scans, as a bundle.
        "bundle_counts": _catalog(_bundle_counts),
        "bundle_overview": _catalog(lambda df: _bundle(df)["overview"]),
        "bundle_text_quality": _catalog(lambda df: _bundle(df)["text_quality"]),
        "bundle_url_checks": _catalog(lambda df: _bundle(df)["url_checks"]),
        # Column-wide date orders; sketches that merge.
        "date_order_votes": _catalog(lambda df: checks.date_order_votes(df, "scraped_at")),
        "elected_timestamps_orders": _native("orders", _elected),
        "sketched_ranges_orders": _native("orders", _sketched_ranges),
        "sketched_distinct_orders": _native("orders", _sketched_distinct),
        "sketched_overlap_orders": _native("orders", _sketched_overlap),
        # Cleaning.
        "sku_dedup": _catalog(lambda df: cleaning.clean_sku(df)[0]),
        "sku_dedup_as_coded": _catalog(lambda df: cleaning.clean_sku(df, CODED)[0]),
        "sku_dedup_blank": _catalog(lambda df: cleaning.clean_sku(_blank_skus(df))[0]),
        "price_clean": _catalog(_price(DEFAULT)),
        "price_clean_as_coded": _catalog(_price(CODED)),
        "brand_clean": _catalog(lambda df: cleaning.clean_brand(df)[0].select("row_number", "brand")),
        "color_extract": _catalog(lambda df: cleaning.extract_color(df)[0].select("row_number", "color")),
        "color_extract_one_space": _catalog(
            lambda df: cleaning.extract_color(df, one_space=True)[0].select("row_number", "color")),
        "size_normalise": _catalog(lambda df: df.select("row_number", sizes.normalise_size(F.col("size")).alias("size"))),
        "size_system": _catalog(lambda df: sizes.add_size_columns(df).select("row_number", "size", "size_system")),
        "size_columns": _catalog(lambda df: sizes.add_size_columns(df).select(
            "row_number", "size_system", "size_count", "size_labels", "size_us", "size_eu", "dimensions_raw", "waist",
            "inseam", "has_petite", "has_tall", "has_plus")),
        "images_clean": _catalog(_images(DEFAULT)),
        "images_clean_as_coded": _catalog(_images(CODED)),
        "cleaned_table": _catalog(_cleaned),
        "cleaned_table_as_coded": _catalog(lambda df: _cleaned(df, CODED)),
        "cleaned_table_raw_images": _catalog(lambda df: _cleaned(df, color_one_space=True, raw_images=True)),
        "clean_missing_summary": _catalog(lambda df: profile.missing_summary(_cleaned(df))),
        "size_system_distribution": _catalog(lambda df: profile.distribution(_cleaned(df), "size_system")),
        "price_flag_distribution": _catalog(lambda df: profile.distribution(_cleaned(df), "price_flag")),
        "drop_log": _catalog(lambda df: clean_plan.clean(df).log_table()),
        "clean_written_counters": _catalog(_counted_write),
        "clean_run_counters": _catalog(clean_plan.run_counters),
        "clean_run_counters_as_coded": _catalog(lambda df: clean_plan.run_counters(df, cfg=CODED)),
        # Scalar functions over whole columns.
        "missing_flags": _catalog(lambda df: df.select(
            "row_number", text.is_missing(F.col("discount")).alias("missing"),
            text.is_numeric_missing(F.col("discount"), DEFAULT.numeric_missing_words).alias("numeric_missing"),
            F.coalesce(text.is_web_url(F.col("url")), F.lit(False)).alias("web_url"))),
        "sanitised_names": _catalog(lambda df: df.select("row_number", text.sanitise(F.col("name")).alias("name"))),
        "trimmed_names": _catalog(lambda df: df.select("row_number", text.trim_all(F.col("name")).alias("name"))),
        "folded_brands": _catalog(lambda df: df.select("row_number", text.fold_latin(F.col("brand")).alias("brand"))),
        "parsed_numbers": _catalog(lambda df: df.select(
            "row_number", numbers.parse_number(F.col("price")).alias("price"),
            numbers.parse_number(F.col("discount")).alias("discount"))),
        "parsed_timestamps": _catalog(lambda df: df.select(
            "row_number", dates.timestamp_text(dates.parse_timestamp(F.col("scraped_at"))).alias("scraped_at"))),
        "image_list_elements": _catalog(lambda df: df.select(
            "row_number", F.posexplode(lists.list_elements(F.col("images"))).alias("position", "element"))),
        "number_formats": _catalog(_number_formats),
        # Steps asked for by the documents only.
        "latest_per_url": _catalog(lambda df: extensions.latest_per_key(df, "url", "scraped_at")),
        "exact_dedup": _catalog(duplicates.drop_exact_duplicates),
        "discount_cap": _catalog(lambda df: extensions.clean_discount(df).select("row_number", "discount", "discount_flag")),
        "url_repair": _catalog(lambda df: extensions.repair_url(df).select("row_number", "url")),
        "squish_all": _catalog(extensions.squish_all),
        "imputation_plan": _catalog(extensions.imputation_plan),
        "imputation_plan_exclude": _catalog(lambda df: extensions.imputation_plan(df, exclude_pct=40.0)),
        "impute_by_levels": _catalog(_imputed_levels),
        "impute_by_size_system": _catalog(_imputed),
        "prepared_table": _catalog(_prepared),
        "prepared_decisions": _catalog(lambda df: prepare.prepare(df).decisions),
        "post_clean_missingness": _catalog(lambda df: profile.missingness_by_variable(_cleaned(df))),
        "post_clean_ranges": _catalog(_post_clean_ranges),
        # The same operators over the native tables.
        "text_quality_documents": _native("documents", lambda df: profile.text_quality(df, columns=["text", "lang", "source"])),
        "text_quality_pages": _native("pages", profile.text_quality),
        "dup_documents": _native("documents", lambda df: duplicates.key_duplicate_counts(df, ["text", "lang", "source"])),
        "dup_lineitem_rows": _native("lineitem", lambda df: duplicates.repeated_key_rows(
            df.select(F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.to_date("l_shipdate").cast("string")).alias("key"), "l_orderkey", "l_linenumber"), "key", Settings(row_id="l_orderkey"))),
        "dup_document_rows": _native("documents", lambda df: duplicates.repeated_key_rows(df, "text", _DOCS)),
        "exact_dedup_documents": _native("documents", lambda df: duplicates.drop_exact_duplicates(df, _DOCS)),
        "url_checks_pages": _native("pages", lambda df: checks.url_column_check(df, "Product URL", "url")),
        "range_checks_lineitem": _native("lineitem", lambda df: rounded(ranges.range_checks(df, _NONE))),
        "range_checks_orders": _native("orders", lambda df: rounded(ranges.range_checks(df))),
        "range_checks_events": _native("events", lambda df: rounded(ranges.range_checks(df, _NONE))),
        "level_summary_customer": _native("customer", lambda df: profile.level_summary(df, ["c_mktsegment", "c_nationkey"], 10)),
        "level_summary_documents": _native("documents", lambda df: profile.level_summary(df, ["lang", "source"])),
        "missingness_events": _native("events", profile.missingness_by_variable),
        "missingness_by_row_events": _native("events", profile.missingness_by_row),
        "inferred_types_orders": _native("orders", lambda df: profile.variable_types(tables.infer_types(
            df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])))),
        "variable_types_customer": _native("customer", profile.variable_types),
        "overview_lineitem": _native("lineitem", lambda df: profile.overview(df, _NONE)),
        "overview_conversations": _native("conversations", lambda df: profile.overview(df, _NONE)),
    }
