"""The diagnostics run in four scans of the source.

Every table of ``diagnose`` comes from one of four narrow intermediate tables, each written once to the shared folder:
counts that one aggregate takes off all rows, counts of values with a tag that says whose they are, the few rows that
some row table lists, and the fields that are numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_timestamp
from ..functions.lists import key_value_pairs, list_elements
from ..functions.text import bounded_key, free_name, is_present, is_web_url, named, rendered, row_digest, squish
from ..operators import attributes, checks, duplicates, profile, ranges
from ..operators.roles import Roles, detect_roles, text_columns
from ..operators.scale import BROADCAST_IDS, mark_listed, sum_all, wide_to_rows
from ..settings import DEFAULT, Settings
from ..sources.identity import pin

# Whose value a counted value is.
ROW, VALUE, TEXT, URL, IMAGE, LEVEL, PAIR = range(7)

# Rows of a task that counts values, and tasks at most: so many that a scanning task streams its rows out to all of them.
TASK_ROWS, TASKS = 20_000, 200


def _entry(tag: int, name: Column, value: Column, gaps: Column | None = None) -> Column:
    return F.struct(F.lit(tag).alias("tag"), name.alias("variable"), value.alias("raw"),
                    (F.array().cast("array<bigint>") if gaps is None else gaps).alias("gaps"))


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """The rows dealt evenly over tasks. A file may be a single piece, and one task would hold the counts of all its rows."""
    tasks = min(TASKS, -(-rows // TASK_ROWS))
    if tasks <= 1:
        return df
    at = free_name(df.columns, "__at")
    return df.withColumn(at, F.monotonically_increasing_id()).repartition(tasks, at).drop(at)


def counted_values(df: DataFrame, roles: Roles, cfg: Settings, rows: int = 0) -> DataFrame:
    """``tag, variable, key, n, valid, gaps`` and the text counts: all groupings of the run in one long form and one aggregate.

    A key is at most 66 characters long but for levels and attributes, which the tables list in full. ``rows`` is the
    number of rows, if known.
    """
    columns, texts = cfg.data_columns(df.columns), text_columns(df)
    masks = profile.gap_masks(df, columns)
    entries = [_entry(ROW, F.lit(""), F.hex(row_digest(df, columns)), F.array(*masks))]
    entries += [_entry(VALUE, F.lit(c), rendered(df, c)) for c in columns]
    entries += [_entry(TEXT, F.lit(c), named(c)) for c in texts]
    entries += [_entry(LEVEL, F.lit(c), rendered(df, c)) for c in profile.level_columns(roles)]
    # As in `diagnose`, the keys of the summary and the levels may be columns that are no data columns.
    entries += [_entry(VALUE, F.lit(c), rendered(df, c)) for c in duplicates.summary_columns(roles) if c not in columns]
    image = _image_column(df, roles, cfg)
    for tag, column in ((URL, roles["product_url"]), (IMAGE, None if image == "images" and checks.checks_image_list(df, roles, cfg) else image)):
        if column:
            entries.append(_entry(tag, F.lit(column), named(column).cast("string")))
    every = F.array(*entries)
    if checks.checks_image_list(df, roles, cfg):
        found = F.transform(list_elements(named("images")), lambda u: _entry(IMAGE, F.lit("images"), u))
        every = F.concat(every, F.when(is_present(named("images")), found).otherwise(F.array().cast(_kind(every, df))))
    if "description" in df.columns:
        found = F.transform(key_value_pairs(named("description")), lambda p: _entry(PAIR, squish(p["attribute_name"]), squish(p["attribute_value"])))
        every = F.concat(every, F.when(is_present(named("description")), found).otherwise(F.array().cast(_kind(every, df))))
    tall = profile.with_clean_text(dealt(df, rows).select(F.inline(every)))
    tag, raw = F.col("tag"), F.col("raw")
    key = F.when(tag == TEXT, bounded_key(F.col("clean"))).when(tag.isin(ROW, LEVEL, PAIR), raw).otherwise(bounded_key(raw))
    # One number per mask: with an array among the aggregates Spark would sort all rows before it groups them.
    counts = profile.text_counts(cfg, tag == TEXT)
    found = tall.groupBy("tag", "variable", key.alias("key")).agg(
        F.count("*").alias("n"), F.count_if(tag.isin(URL, IMAGE) & is_web_url(raw)).alias("valid"),
        *[F.first(F.get("gaps", F.lit(i))).alias(f"gaps_{i}") for i in range(len(masks))], *counts)
    gaps = F.when(tag == ROW, F.array(*[F.col(f"gaps_{i}") for i in range(len(masks))])).otherwise(F.array().cast("array<bigint>"))
    return found.select("tag", "variable", "key", "n", "valid", gaps.alias("gaps"), *found.columns[5 + len(masks):])


def _kind(array: Column, df: DataFrame):
    return df.select(array.alias("a")).schema["a"].dataType


def _image_column(df: DataFrame, roles: Roles, cfg: Settings) -> str | None:
    return "images" if checks.checks_image_list(df, roles, cfg) else roles["image_url"]


def _facts(df: DataFrame, roles: Roles, conditions: dict[str, Column], cfg: Settings) -> DataFrame:
    """One row: price and discount counts, timestamps, image lists with repeats."""
    stamp, rows = roles["scraped_at"], df
    found = [F.count("*").alias("rows")] + [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())]
    if "images" in df.columns:
        found.append(F.count_if(duplicates.repeats_element(named("images"))).alias("records"))
    if stamp:
        needed = list(dict.fromkeys([c for c in (roles["price"], roles["discount"], "images" if "images" in df.columns else None) if c]))
        text = named(stamp).cast("string")
        rows = df.select(*[named(c) for c in needed if c not in ("raw", "at")], text.alias("raw"), parse_timestamp(text, cfg.date_orders).alias("at"))
        found += checks.datetime_counts(stamp)
    return rows.agg(*found)


def _listed_rows(df: DataFrame, values: DataFrame, roles: Roles, cfg: Settings) -> tuple[DataFrame, dict[str, str]]:
    """The rows that some row table lists, with a flag for each table, and the flags' names."""
    columns = df.columns
    flag = {name: free_name(columns, f"__{name}") for name in ("problem", "unparsed", "copy", "url", "digest", "url_key")}
    problem = sum_all([f.cast("int") for f in checks.flag_columns(roles).values()] or [F.lit(0)]) > 0
    marked = df.withColumn(flag["problem"], problem).withColumn(flag["unparsed"], ranges.parse_failure_count(df, cfg) > 0)
    lists = [("copy", flag["digest"], F.hex(row_digest(df, cfg.data_columns(columns))), values.where((F.col("tag") == ROW) & (F.col("n") > 1)))]
    if roles["product_url"]:
        url = roles["product_url"]
        repeated = values.where((F.col("tag") == VALUE) & (F.col("variable") == url) & (F.col("n") > 1) & is_present(F.col("key")))
        lists.append(("url", flag["url_key"], bounded_key(rendered(df, url)), repeated))
    else:
        marked = marked.withColumn(flag["url"], F.lit(False))
    for name, key, value, listed in lists:
        # A row with a bounded list at hand is decided on the spot; only beyond the bound rows move.
        listed = listed.select(F.col("key").alias(key), F.col("n").alias("__n"))
        keyed = marked.withColumn(key, value)
        if listed.count() <= BROADCAST_IDS:
            met = keyed.join(F.broadcast(listed.select(key, F.lit(True).alias(flag[name]))), key, "left")
            marked = met.withColumn(flag[name], F.coalesce(F.col(flag[name]), F.lit(False))).drop(key)
        else:
            marked = mark_listed(keyed, listed, key, "__n", cfg.row_id, flag[name]).drop(key)
    any_flag = F.col(flag["problem"]) | F.col(flag["unparsed"]) | F.col(flag["copy"]) | F.col(flag["url"])
    return marked.where(any_flag), flag


def diagnose_stored(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The tables of ``diagnose``, equal to them; the source is read four times in all, when this is called.

    The intermediate tables lie in the shared folder. For sources that are read slowly or computed anew at each reading.
    """
    roles = roles or detect_roles(df)
    spark, columns, types = df.sparkSession, cfg.data_columns(df.columns), dict(df.dtypes)
    conditions = checks.price_discount_conditions(roles)
    facts = pin(_facts(df, roles, conditions, cfg))
    values = pin(counted_values(df, roles, cfg, facts.first()["rows"]), by="tag")
    rows, flag = _listed_rows(df, values, roles, cfg)
    rows = pin(rows)
    number_columns = ranges.range_columns(df, cfg)
    numbers = pin(ranges.parsed_numbers(df, number_columns, cfg)) if number_columns else None

    def tagged(tag: int) -> DataFrame:
        return values.where(F.col("tag") == tag)

    def listed(name: str) -> DataFrame:
        return rows.where(named(flag[name])).select(*[named(c) for c in df.columns])

    per_row = tagged(ROW).select("n", *[F.col("gaps")[w].alias(f"gaps_{w}") for w in range(len(profile.gap_masks(df, columns)))])
    gaps = sum_all([F.bit_count(c) for c in per_row.columns if c != "n"])
    per_value = tagged(VALUE).select("variable", "key", "n")
    totals = per_row.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), *[
        F.coalesce(F.sum(F.when(profile.gap_in(i), F.col("n"))), F.lit(0)).alias(f"m{i}") for i in range(len(columns))])
    counts = wide_to_rows(totals, [[F.lit(i), F.lit(c), F.col(f"m{i}"), F.col("rows")] for i, c in enumerate(columns)],
                          ["ordinal", "variable", "missing_count", "rows"])
    present = {c: F.col("rows") - F.col(f"m{i}") for i, c in enumerate(columns)}
    keys = duplicates.summary_columns(roles)
    key_counts = duplicates.key_copies_of(per_value.where(F.col("variable").isin(keys) & is_present(F.col("key")))) if keys else None
    pairs = tagged(PAIR).select(F.col("variable").alias("attribute_name"), F.col("key").alias("attribute_value"), "n")
    found_in = wide_to_rows(totals, [[F.lit(role), F.lit(c), present[c] if c in present else F.lit(None).cast("bigint")] for role, c in roles.items()],
                            ["expected_field", "detected_column", "present_rows"])

    def url_table() -> DataFrame:
        product = (checks.url_stats_of(tagged(URL).where(is_present(F.col("key"))), "Product URL", roles["product_url"]) if roles["product_url"]
                   else checks.url_column_check(df, "Product URL", None))
        image = _image_column(df, roles, cfg)
        return product.unionByName(checks.url_stats_of(tagged(IMAGE).where(is_present(F.col("key"))), "Image URL", image) if image
                                   else checks.url_column_check(df, "Image URL", None))

    def attribute_table(by: list[str]) -> DataFrame:
        there = pairs
        for k in by:
            there = there.where(is_present(F.col(k)))
        return there.groupBy(*by).agg(F.sum("n").alias("count")).orderBy(F.desc("count"), *by)

    levels = profile.level_columns(roles)
    return {
        "overview": profile.overview_of(per_row, columns),
        "detected_columns": found_in.withColumn("detected_column", F.col("detected_column").cast("string")),
        "variable_types": profile.variable_types_of(per_value.where(F.col("variable").isin(columns)), columns, types),
        "missingness_by_variable": profile.missingness_of(counts),
        "missingness_by_row": per_row.groupBy(gaps.alias("missing_values_per_row")).agg(F.sum("n").alias("row_count")).orderBy(F.desc("missing_values_per_row")),
        "duplicate_summary": duplicates.duplicate_summary_of(per_row.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies")), key_counts, roles),
        "exact_dup_rows": listed("copy"),
        "dup_url_rows": listed("url"),
        "image_dup_summary": duplicates.image_dup_table(facts) if "images" in df.columns else duplicates.image_dup_summary(df),
        "range_checks": ranges.range_checks_of(numbers, number_columns, types, cfg) if numbers is not None else ranges.range_checks(df, cfg),
        "numeric_parse_issues": ranges.numeric_parse_issues(rows.where(named(flag["unparsed"])).select(*[named(c) for c in df.columns]), cfg),
        "price_discount_checks": checks.price_discount_table(facts, conditions) if conditions else checks.price_discount_checks(df, roles),
        "url_checks": url_table(),
        "datetime_checks": (facts.select("variable", "total_non_missing", "parsed_count", "unparsed_count", "earliest_date", "latest_date")
                            if roles["scraped_at"] else checks.datetime_checks(df, roles, cfg)),
        "text_quality": profile.text_quality_of(tagged(TEXT), text_columns(df)),
        "level_summary": profile.levels_of(tagged(LEVEL).where(is_present(F.col("key"))).select("variable", F.col("key").alias("value"), F.col("n").alias("count")), levels)
        if levels else profile.level_summary(df, levels),
        "attr_names": attribute_table(["attribute_name"]),
        "attr_values": attribute_table(["attribute_value"]),
        "attr_name_values": attribute_table(["attribute_name", "attribute_value"]),
        "problem_rows": listed("problem"),
    }
