"""Properties and behaviour of the profile, duplicate, check and report tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftloom import CODED, alerts, detect_roles, diagnose, executive_metrics, issue_register
from siftloom.operators import checks, duplicates, profile, ranges, scale
from siftloom.operators.roles import LOOSE_PATTERNS, find_column, numeric_like_columns, priority_first
from siftloom.plans.diagnose import diagnose_loose
from siftloom.plans.report import facts
from siftloom.queries.registry import rounded
from siftloom.settings import Settings
from tests.conftest import rows

SCHEMA = "row_number long, sku string, url string, name string, price string"


def test_roles(catalog):
    strict = detect_roles(catalog)
    assert {k: v for k, v in strict.items() if v} == {
        "product": "name", "price": "price", "discount": "discount", "size": "size", "product_url": "url",
        "scraped_at": "scraped_at"}
    assert detect_roles(catalog, LOOSE_PATTERNS)["image_url"] == "images"
    assert find_column(["A", "Sale_Price", "price"], "price") == "Sale_Price"
    assert find_column(["A"], "price") is None


def test_numeric_like_columns_are_unique_and_ordered(spark):
    df = spark.createDataFrame([], "country string, price double, stock string, id long")
    assert numeric_like_columns(df) == ["price", "id", "country", "stock"]


def test_priority_first(spark):
    df = spark.createDataFrame([], "c string, b string, a string")
    assert priority_first(df, ["a", "x", "b"]).columns == ["a", "b", "c"]


def test_missing_plus_present_is_all(catalog):
    n = catalog.count()
    for r in profile.missingness_by_variable(catalog).collect():
        assert r.missing_count + r.non_missing == n
    histogram = profile.missingness_by_row(catalog).collect()
    assert sum(r.row_count for r in histogram) == n
    total = sum(r.row_count * r.missing_values_per_row for r in histogram)
    assert total == sum(r.missing_count for r in profile.missingness_by_variable(catalog).collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_results_do_not_depend_on_partitions(catalog, parts):
    moved = catalog.repartition(parts)
    roles = detect_roles(catalog)
    for build in (profile.overview, profile.variable_types, profile.text_quality, ranges.range_checks,
                  duplicates.exact_duplicate_rows, lambda d: checks.problem_rows(d, roles)):
        assert rows(rounded(build(catalog))) == rows(rounded(build(moved)))


def test_exact_duplicates_as_coded_are_zero(catalog):
    assert duplicates.exact_duplicate_count(catalog).first().copies > 0
    assert duplicates.exact_duplicate_count(catalog, CODED).first().copies == 0
    assert duplicates.exact_duplicate_rows(catalog, CODED).count() == 0


def test_profile_as_coded_includes_the_row_number(catalog):
    assert profile.missingness_by_variable(catalog, CODED).count() == profile.missingness_by_variable(catalog).count() + 1
    assert "row_number" in [r.variable for r in ranges.range_checks(catalog, CODED).collect()]


def test_line_breaks_vanish_as_coded(catalog):
    newline = lambda cfg: {r.variable: r.newline_count for r in profile.text_quality(catalog, cfg).collect()}["name"]
    assert newline(Settings()) > 0 and newline(CODED) == 0


def test_approximations_are_close(catalog):
    exact = {r.variable: r for r in profile.variable_types(catalog).collect()}
    for r in profile.variable_types(catalog, approx=True).collect():
        assert abs(r.unique_count - exact[r.variable].unique_count) <= 0.15 * exact[r.variable].unique_count + 1
        assert r.missing_count == exact[r.variable].missing_count
    near = {r.variable: r.median for r in ranges.range_checks(catalog, approx=True).collect()}
    for r in ranges.range_checks(catalog).collect():
        assert near[r.variable] == pytest.approx(r.median, rel=0.05)


def test_dedup_keeps_first_and_is_idempotent(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "row_number long, sku string")
    once = duplicates.keep_first_per_key(df, "sku")
    assert rows(once) == [(1, "a"), (2, None), (4, None), (5, "b")]
    assert rows(duplicates.keep_first_per_key(once, "sku")) == rows(once)
    assert rows(duplicates.keep_first_per_key(df, "sku", CODED)) == [(1, "a"), (2, None), (5, "b")]


def test_repeated_key_rows_ignore_missing_keys(spark):
    df = spark.createDataFrame([(1, "u"), (2, "u"), (3, ""), (4, ""), (5, None), (6, None), (7, "v")], "row_number long, url string")
    assert [r.row_number for r in duplicates.repeated_key_rows(df, "url").collect()] == [1, 2]
    assert [r.row_number for r in duplicates.repeated_key_rows(df, "url", n=1).collect()] == [1]


def test_tables_without_their_columns_are_empty_with_the_usual_schema(spark):
    df = spark.createDataFrame([(1, "x")], "row_number long, other string")
    roles = detect_roles(df)
    for table, full in (
            (checks.price_discount_checks(df, roles), ["check", "count"]),
            (checks.datetime_checks(df, roles), ["variable", "total_non_missing", "parsed_count", "unparsed_count",
                                                 "earliest_date", "latest_date"]),
            (ranges.range_checks(df), None), (ranges.numeric_parse_issues(df), None),
            (profile.level_summary(df, [], 5), ["variable", "value", "count"])):
        assert table.count() == 0
        assert full is None or table.columns == full
    flags = checks.issue_flags(df, roles).first()
    assert tuple(flags) == (1, 0)
    assert [r.variable for r in checks.url_checks(df, roles).collect()] == [None, None]


def test_parse_vocabularies_differ(spark):
    df = spark.createDataFrame([(1, "undefined"), (2, "abc"), (3, "5"), (4, ""), (5, None)], "row_number long, price string")
    assert [r.row_number for r in ranges.numeric_parse_issues(df).collect()] == [2]
    by_check = {r["check"]: r["count"] for r in checks.price_discount_checks(df, detect_roles(df)).collect()}
    assert by_check["Price: could not be parsed"] == 2


def test_outliers_lie_strictly_outside(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0]  # quartiles 2 and 4, fences -1 and 7
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values])], "row_number long, price double")
    assert ranges.range_checks(df).first().iqr_outlier_count == 0
    more = df.union(spark.createDataFrame([(9, 100.0)], df.schema))
    assert ranges.range_checks(more).first().iqr_outlier_count == 1


def test_diagnose_has_twenty_tables(catalog):
    tables = diagnose(catalog)
    assert len(tables) == 20 and len(diagnose_loose(catalog)) == 19
    assert all(t.columns for t in tables.values())


def test_report(catalog):
    register = issue_register(catalog)
    assert [r.id for r in register.collect()] == ["S1", "S2", "D1", "D2", "D3", "P1", "P2", "P3", "P4", "U1", "T1", "T2", "DT1", "I1"]
    known = {r.fact: r.value for r in facts(catalog).collect()}
    one = executive_metrics(catalog).first()
    assert (one.total_rows, one.total_columns, one.exact_duplicates) == (known["rows"], 10, known["exact_duplicates"])
    coded = {r.fact: r.value for r in facts(catalog, cfg=CODED).collect()}
    assert coded["image_duplicates"] == 0 and known["image_duplicates"] > 0
    fired = {r.rule: r.severity for r in alerts(catalog).collect()}
    assert fired["duplicate_urls"] == "high" and "no_price_or_discount_issue" not in fired


def test_alerts_on_a_clean_table(spark):
    df = spark.createDataFrame([(1, "a", "https://x/1", "n1", "5")], SCHEMA)
    fired = {r.rule: r.severity for r in alerts(df.withColumn("images", F.lit("['https://x/a']"))).collect()}
    assert fired == {"image_duplicates": "medium", "high_missing_columns": "low", "parse_failures": "low",
                     "no_price_or_discount_issue": "low", "url_issues": "low", "no_timestamp_column": "medium"}


def test_overview_of_a_wide_table(spark):
    names = [f"c{i}" for i in range(70)]
    full, gap = ["x"] * 70, ["x"] * 65 + [None, "", "x", "x", "x"]
    df = spark.createDataFrame([full, full, gap], names)
    got = {r.metric: r.value for r in profile.overview(df).collect()}
    assert list(got.values()) == [3, 70, 210, 1, 1, 2]


def test_rows_with_numbers_are_compared_by_value(spark):
    df = spark.createDataFrame([(1, 0.0, None, "a"), (2, -0.0, None, "a"), (3, 0.0, 0, "a"), (4, 0.0, None, None)],
                               "row_number long, v double, n int, s string")
    assert duplicates.exact_duplicate_count(df).first().copies == 1


def test_one_row_identity_everywhere(spark):
    zero = spark.createDataFrame([(1, 0.0, ["a, b"]), (2, -0.0, ["a, b"]), (3, float("nan"), ["a", "b"]), (4, float("nan"), ["a", "b"])],
                                 "row_number long, x double, a array<string>")
    wide = zero.select("*", *[F.col("x").alias(f"x{i}") for i in range(20)])
    inner = zero.select("row_number", F.array("x").alias("l"), F.struct("x", "a").alias("s"), F.create_map(F.lit("k"), "x").alias("m"))
    for df in (zero, wide, inner):
        copies = {r.metric: r.value for r in profile.overview(df).collect()}["Exact duplicate rows"]
        assert copies == 2 and duplicates.exact_duplicate_count(df).first().copies == 2
        assert sorted(r.row_number for r in duplicates.exact_duplicate_rows(df).collect()) == [1, 2, 3, 4]
        assert sorted(r.row_number for r in duplicates.drop_exact_duplicates(df).collect()) == [1, 3]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "row_number long, price double")
    assert profile.missingness_by_variable(df).first().missing_count == 2
    assert profile.variable_types(df).first().missing_count == 2
    assert ranges.range_checks(df).first().parsed_count == 1


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "", 3.0), (2, None, 4.0)], "row_number long, `a.b` string, `price.usd` double")
    assert {r.variable: r.missing_count for r in profile.missingness_by_variable(df).collect()} == {"a.b": 2, "price.usd": 0}
    assert [r.variable for r in ranges.range_checks(df).collect()] == ["price.usd"]
    assert profile.text_quality(df).count() == 1 and profile.variable_types(df).count() == 2
    assert duplicates.exact_duplicate_count(df).first().copies == 0


def test_values_close_together_stay_in_small_buckets(spark):
    df = spark.range(100_000).select(F.lit("g").alias("g"), (F.lit(100.0) + F.col("id") * 1e-14 * 3).alias("v"))
    values = sorted(100.0 + i * 1e-14 * 3 for i in range(100_000))
    got = scale.exact_quantiles(df, "g", "v", [0.5]).first().q0
    assert got == pytest.approx((values[49_999] + values[50_000]) / 2, abs=1e-15)
