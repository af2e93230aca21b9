"""Checks on prices, discounts, URLs and timestamps, and the row flags built from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_timestamp, timestamp_text
from ..functions.lists import list_elements
from ..functions.numbers import parse_number
from ..functions.text import bounded_key, is_missing, is_present, is_web_url
from ..settings import DEFAULT, Settings
from .roles import Roles
from .scale import first_rows, sum_all, wide_to_rows


def _number(column: str) -> Column:
    return parse_number(F.col(column).cast("string"))


def price_discount_checks(df: DataFrame, roles: Roles) -> DataFrame:
    """``check, count``: what cannot be parsed, is negative, zero or above 100 percent."""
    checks = price_discount_conditions(roles)
    if not checks:
        return df.sparkSession.createDataFrame([], "check string, count bigint")
    return price_discount_table(df.agg(*[F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(checks.values())]), checks)


def price_discount_table(totals: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``price_discount_checks`` from its counts ``c0``, ``c1``, ..."""
    return wide_to_rows(totals, [[F.lit(label), F.col(f"c{i}")] for i, label in enumerate(checks)], ["check", "count"])


def price_discount_conditions(roles: Roles) -> dict[str, Column]:
    checks: list[tuple[str, Column]] = []
    if roles["price"]:
        c, v = F.col(roles["price"]), _number(roles["price"])
        checks += [("Price: could not be parsed", v.isNull() & is_present(c)),
                   ("Price: < 0", v < 0), ("Price: == 0", v == 0)]
    if roles["discount"]:
        c, v = F.col(roles["discount"]), _number(roles["discount"])
        checks += [("Discount: could not be parsed", v.isNull() & is_present(c)),
                   ("Discount: < 0", v < 0), ("Discount: > 100", v > 100)]
    return dict(checks)


_URL_SCHEMA = ("url_type string, variable string, total_non_missing bigint, valid_count bigint,"
               " invalid_count bigint, duplicate_count bigint")


def _url_stats(values: DataFrame, url_type: str, variable: str) -> DataFrame:
    present = values.where(is_present(F.col("url")))
    per_url = present.groupBy(bounded_key(F.col("url")).alias("key")).agg(
        F.count("*").alias("n"), F.count_if(is_web_url(F.col("url"))).alias("valid"))
    return url_stats_of(per_url, url_type, variable)


def url_stats_of(per_url: DataFrame, url_type: str, variable: str) -> DataFrame:
    """One row on a URL column from ``n`` and ``valid`` of each distinct URL."""
    n, valid = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("valid"), F.lit(0))
    return per_url.agg(
        F.lit(url_type).alias("url_type"), F.lit(variable).alias("variable"),
        n.alias("total_non_missing"), valid.alias("valid_count"), (n - valid).alias("invalid_count"),
        (n - F.count("*")).alias("duplicate_count"))


def url_column_check(df: DataFrame, url_type: str, column: str | None, as_list: bool = False) -> DataFrame:
    """One row on one URL column; with ``as_list`` the elements of the serialised lists are checked."""
    if column is None:
        return df.sparkSession.createDataFrame([(url_type, None, None, None, None, None)], _URL_SCHEMA)
    if as_list:
        values = df.where(is_present(F.col(column))).select(F.explode(list_elements(F.col(column))).alias("url"))
    else:
        values = df.select(F.col(column).cast("string").alias("url"))
    return _url_stats(values, url_type, column)


def url_checks(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT, image_list: str | None = "images") -> DataFrame:
    """``url_type, variable, total_non_missing, valid_count, invalid_count, duplicate_count``.

    Image URLs kept as a serialised list are checked one by one. As coded, only
    a column with an image-URL name is checked, and as a whole.
    """
    product = url_column_check(df, "Product URL", roles["product_url"])
    if checks_image_list(df, roles, cfg, image_list):
        image = url_column_check(df, "Image URL", image_list, as_list=True)
    else:
        image = url_column_check(df, "Image URL", roles["image_url"])
    return product.unionByName(image)


def checks_image_list(df: DataFrame, roles: Roles, cfg: Settings, image_list: str | None = "images") -> bool:
    return not cfg.as_coded and roles["image_url"] in (None, image_list) and image_list in df.columns


def invalid_url_count(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT, image_list: str = "images") -> Column:
    """How many URLs of a row are present but not web URLs; row-local, no distinct values needed."""
    def invalid(c: Column) -> Column:
        return is_present(c) & ~is_web_url(c)

    count = F.lit(0)
    if roles["product_url"]:
        count = count + F.coalesce(invalid(F.col(roles["product_url"]).cast("string")), F.lit(False)).cast("int")
    if checks_image_list(df, roles, cfg, image_list):
        bad = F.size(F.filter(list_elements(F.col(image_list)), invalid))
        count = count + F.when(is_present(F.col(image_list)), bad).otherwise(0)
    elif roles["image_url"]:
        count = count + F.coalesce(invalid(F.col(roles["image_url"]).cast("string")), F.lit(False)).cast("int")
    return count


def datetime_checks(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT) -> DataFrame:
    """``variable, total_non_missing, parsed_count, unparsed_count, earliest_date, latest_date``."""
    column = roles["scraped_at"]
    if column is None:
        return df.sparkSession.createDataFrame(
            [], "variable string, total_non_missing bigint, parsed_count bigint, unparsed_count bigint,"
                " earliest_date string, latest_date string")
    text = F.col(column).cast("string")
    parsed = df.select(text.alias("raw"), parse_timestamp(text, cfg.date_orders).alias("at"))
    return parsed.agg(*datetime_counts(column))


def datetime_counts(column: str) -> list[Column]:
    """What ``datetime_checks`` finds, as aggregates over ``raw`` and ``at``."""
    present = is_present(F.col("raw"))
    return [
        F.lit(column).alias("variable"), F.count_if(present).alias("total_non_missing"),
        F.count("at").alias("parsed_count"), F.count_if(present & F.col("at").isNull()).alias("unparsed_count"),
        timestamp_text(F.min("at")).alias("earliest_date"), timestamp_text(F.max("at")).alias("latest_date")]


def date_order_votes(df: DataFrame, column: str, cfg: Settings = DEFAULT) -> DataFrame:
    """``date_order, parsed, only_parsed``: how many texts of a column fit each order of year, month and day, and how many no other.

    Most votes first, ties in the order of the settings. One pass over the column.
    """
    names = list(dict.fromkeys(o.partition(" ")[0] for o in cfg.date_orders))
    text = F.col(column).cast("string")
    fits = df.select(*[parse_timestamp(text, tuple(o for o in cfg.date_orders if o.partition(" ")[0] == name)).isNotNull().alias(name) for name in names])
    only = {n: sum_all([F.col(o).cast("int") for o in names]) == 1 for n in names}
    totals = fits.agg(*[F.count_if(F.col(n)).alias(f"{n}_all") for n in names], *[F.count_if(F.col(n) & only[n]).alias(f"{n}_only") for n in names])
    listed = wide_to_rows(totals, [[F.lit(n), F.col(f"{n}_all"), F.col(f"{n}_only"), F.lit(i)] for i, n in enumerate(names)],
                          ["date_order", "parsed", "only_parsed", "listed"])
    return listed.orderBy(F.desc("parsed"), "listed").select("date_order", "parsed", "only_parsed")


def elected_orders(df: DataFrame, column: str, cfg: Settings = DEFAULT) -> Settings:
    """Settings whose date orders are tried in the order of the column's votes.

    So ``03/02/2024`` is read as the column's unambiguous dates are, ``13/02/2024`` for one, and not by what the settings list
    first; texts that fit other orders only still parse by them.
    """
    winners = [r["date_order"] for r in date_order_votes(df, column, cfg).collect()]
    return replace(cfg, date_orders=tuple(o for w in winners for o in cfg.date_orders if o.partition(" ")[0] == w))


def flag_columns(roles: Roles) -> dict[str, Column]:
    """The row flags that the known roles allow; never NULL."""
    flags: dict[str, Column] = {}
    if roles["price"]:
        v = _number(roles["price"])
        flags["price_missing_or_invalid"] = v.isNull()
        flags["price_negative"] = v < 0
    if roles["discount"]:
        v = _number(roles["discount"])
        flags["discount_over_100"] = v > 100
        flags["discount_negative"] = v < 0
    for role, name in (("product_url", "product_url_invalid"), ("image_url", "image_url_invalid")):
        if roles[role]:
            c = F.col(roles[role]).cast("string")
            flags[name] = ~is_missing(c) & ~is_web_url(c)
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}


def with_issue_flags(df: DataFrame, roles: Roles) -> DataFrame:
    """The rows with their flags and ``issue_count`` beside them; no join is needed later."""
    flags = flag_columns(roles)
    flagged = df.select("*", *[flag.alias(name) for name, flag in flags.items()])
    count = sum_all([F.col(name).cast("int") for name in flags]) if flags else F.lit(0)
    return flagged.withColumn("issue_count", count)


def issue_flags(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT) -> DataFrame:
    return with_issue_flags(df, roles).select(cfg.row_id, *flag_columns(roles), "issue_count")


def problem_rows(df: DataFrame, roles: Roles, cfg: Settings = DEFAULT, n: int | None = None) -> DataFrame:
    """The rows with at least one flag; with ``n`` the first ``n`` by row id, in that order."""
    flagged = with_issue_flags(df, roles).where(F.col("issue_count") > 0).select(*df.columns)
    return flagged if n is None else first_rows(flagged, n, cfg.row_id)
