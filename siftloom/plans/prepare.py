"""The documented cleaning sequence as one run, in its documented order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parse_timestamp
from ..functions.text import free_name, is_present, named
from ..operators import cleaning, extensions
from ..operators.duplicates import drop_exact_duplicates
from ..operators.roles import Roles, detect_roles
from ..operators.scale import last_per_key
from ..settings import DEFAULT, Settings


@dataclass(frozen=True)
class Prepared:
    """The table after all steps, and what to do about each column's gaps."""

    table: DataFrame
    decisions: DataFrame


def latest_scrape(df: DataFrame, url: str, stamp: str, cfg: Settings = DEFAULT) -> DataFrame:
    """Of the rows with a URL the latest per URL; rows without one all stay, each under a key of its own."""
    key = F.when(is_present(named(url)), F.concat(F.lit("key:"), named(url)))
    name = free_name(df.columns, "__url")
    keyed = df.withColumn(name, F.coalesce(key, F.concat(F.lit("row:"), F.col(cfg.row_id).cast("string"))))
    order = F.struct(parse_timestamp(named(stamp), cfg.date_orders), -F.col(cfg.row_id))
    return last_per_key(keyed, [name], order).drop(name)


def prepare(df: DataFrame, roles: Roles | None = None, cfg: Settings = DEFAULT) -> Prepared:
    """Exact copies out, latest scrape per URL, prices and discounts as numbers, URLs repaired, image lists without
    repeats, white space squished; then a decision per column. Steps whose columns are absent are skipped.

    Further date orders are a setting (``date_orders``). The decisions read the table once more.
    """
    roles = roles or detect_roles(df)
    df = drop_exact_duplicates(df, cfg)
    url, stamp = roles["product_url"], roles["scraped_at"]
    if url and stamp:
        df = latest_scrape(df, url, stamp, cfg)
    df, _ = cleaning.clean_price(df, roles["price"], cfg)
    if roles["discount"]:
        df = extensions.clean_discount(df, roles["discount"])
    if url:
        df = extensions.repair_url(df, url)
    df, _ = cleaning.clean_images(df, cfg=cfg)
    df = extensions.squish_all(df)
    return Prepared(df, extensions.imputation_plan(df, cfg))
