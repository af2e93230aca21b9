"""The whole cleaner, its log, the documented extensions, and cleaning on a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftloom import CODED, Cleaned, clean, clean_rows, detect_roles
from siftloom.operators import extensions
from siftloom.plans.clean import PRIORITY, run_counters
from siftloom.sources.identity import pin
from tests.conftest import SF, rows


def test_columns_log_and_summaries(catalog):
    done = clean(catalog)
    assert done.table.columns == [*PRIORITY, "row_number", "discount", "scraped_at"]
    assert [(e.column, e.action) for e in done.log] == [
        ("price", "replaced"), ("description", "dropped"), ("size", "replaced"), ("images", "replaced")]
    assert done.log_table().count() == 4
    tables = done.summaries()
    assert set(tables) == {"missing_summary", "size_system_distribution", "price_flag_distribution"}
    n = done.table.count()
    assert sum(r["count"] for r in tables["size_system_distribution"].collect()) == n


@pytest.mark.parametrize("parts", [1, 7])
def test_independent_of_partitions(catalog, parts):
    assert rows(clean(catalog.repartition(parts)).table) == rows(clean(catalog).table)


def test_cleaning_again_changes_nothing(catalog):
    once = clean(catalog).table
    again = clean(once.withColumn("price", F.col("price").cast("string"))).table
    same = ["sku", "price", "price_flag", "brand", "color", "size_system", "images_clean"]
    assert rows(again.select(*same)) == rows(once.select(*same))


def test_statistics_of_the_stored_table(catalog):
    done = clean(catalog)
    stored = Cleaned(pin(done.table), done.log)
    ranges = {r.variable: r for r in stored.statistics()["ranges"].collect()}
    assert set(ranges) == {"price", "size_count", "images_n", "discount"} and ranges["images_n"].max == 2.0


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([(1, "x")], "row_number long, other string")
    done = clean(df)
    assert done.table.columns == df.columns and done.log == []


def test_price_column_is_renamed(spark):
    df = spark.createDataFrame([(1, "$3")], "row_number long, sale_price string")
    row = clean(df).table.first()
    assert (row.price, row.price_flag) == (3.0, "ok")


def test_older_rules(catalog):
    old = clean(catalog, color_one_space=True, raw_images=True).table
    assert "images" in old.columns and "images_clean" not in old.columns
    assert old.where("color is not null").count() < clean(catalog).table.where("color is not null").count()


def test_run_counters(catalog):
    values = {r.counter: r.value for r in run_counters(catalog).collect()}
    assert values["rows_before_dedup"] == catalog.count()
    assert values["rows_before_dedup"] - values["rows_after_dedup"] == values["duplicate_rows_removed"]
    coded = {r.counter: r.value for r in run_counters(catalog, cfg=CODED).collect()}
    assert coded["rows_after_dedup"] < values["rows_after_dedup"]


def test_rows_can_be_cleaned_on_a_stream(spark, catalog, tmp_path):
    catalog.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(catalog.schema).parquet(str(tmp_path / "in"))
    query = (clean_rows(stream, detect_roles(catalog)).table.writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(clean_rows(catalog, detect_roles(catalog)).table)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "u", "2024-01-01"), (2, "u", "03/01/2024"), (3, "u", "junk"), (4, "u", "2024-03-01"), (5, "v", "junk"), (6, "", "2024-01-01")],
        "row_number long, url string, scraped_at string")
    assert [r.row_number for r in extensions.latest_per_key(df, "url", "scraped_at").orderBy("row_number").collect()] == [2, 5]


def test_discount_and_url_repair(spark):
    df = spark.createDataFrame([("150%",), ("-10%",), ("n/a",), ("20%",), ("",)], "discount string")
    assert [tuple(r) for r in extensions.clean_discount(df).collect()] == [
        (100.0, "invalid"), (-10.0, "invalid"), (None, "unparsed"), (20.0, "ok"), (None, "missing")]
    urls = spark.createDataFrame([("https://a",), ("www.a.b",), ("ftp://x",), ("",)], "url string")
    assert [r.url for r in extensions.repair_url(urls).collect()] == ["https://a", "https://www.a.b", None, None]


def test_impute_by_group(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, "x"), (2, "a", 4.0, "y"), (3, "a", None, "y"), (4, "a", 2.0, ""), (5, "b", None, None), (6, "b", 9.0, "q"),
         (7, None, 3.0, "n"), (8, None, float("nan"), None)],
        "row_number long, g string, price double, brand string")
    got = extensions.impute_by_group(df, "g", ["price", "brand"]).orderBy("row_number").collect()
    assert [(r.price, r.price_imputed, r.brand, r.brand_imputed) for r in got] == [
        (1.0, False, "x", False), (4.0, False, "y", False), (2.0, True, "y", False), (2.0, False, "y", True),
        (9.0, True, "q", True), (9.0, False, "q", False), (3.0, False, "n", False), (3.0, True, "n", True)]


def test_imputation_plan_and_documented_columns(catalog):
    plan = {r.variable: r.decision for r in extensions.imputation_plan(catalog).collect()}
    assert plan["images"] == "document" and plan["name"] == "keep" and plan["sku"] == "impute"
    assert [r.variable for r in extensions.documented_only(catalog).collect()] == ["images"]


def test_image_scrape_dates(spark):
    df = spark.createDataFrame(
        [(1, "['https://i/2023/05/06/a.jpg', 'https://i/2023/05/06/b.jpg', 'https://i/2024/01/02/c.jpg']"), (2, "['https://i/a.jpg']"), (3, None)],
        "row_number long, images string")
    assert rows(extensions.image_scrape_dates(df)) == [(1, "2023-05-06"), (1, "2024-01-02")]


def test_pin_keeps_the_table(spark, catalog):
    assert rows(pin(catalog)) == rows(catalog)
    assert SF


def test_two_price_columns(spark):
    df = spark.createDataFrame([(1, "$3", "-$4.00"), (2, "($5.00)", "x")], "row_number long, sale_price string, price string")
    done = clean(df)
    assert [e.action for e in done.log] == ["renamed", "replaced"]
    assert [(r.price, r.price_other) for r in done.table.orderBy("row_number").collect()] == [(3.0, "-$4.00"), (-5.0, "x")]


def test_truncated_colour(spark):
    df = spark.createDataFrame([(1, "[{'Color': 'Bla")], "row_number long, description string")
    assert clean(df).table.first().color == "Bla" and clean(df, cfg=CODED).table.first().color == "Bla"
