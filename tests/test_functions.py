"""Scalar functions against hand-checked values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftloom.functions import dates, lists, numbers, text
from siftloom.operators import cleaning
from siftloom.settings import CODED, DEFAULT, NUMERIC_MISSING_WORDS


def apply(spark, expression, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_parse_number(spark):
    got = apply(spark, numbers.parse_number, "$12,500.50", "$-5.00", "$5.00-$7.00", "undefined", "", None, "150%", ".5", "1-2")
    assert got == [12500.5, -5.0, 5.0, None, None, None, 150.0, 0.5, 1.0]


def test_clean_price_modes(spark):
    values = ["$12,500.50", "$-5.00", "$5.00-$7.00", "undefined", "$7.25"]
    assert apply(spark, lambda c: cleaning.price_number(c, CODED), *values) == [12500.5, 5.0, None, None, 7.25]
    assert apply(spark, lambda c: cleaning.price_number(c, DEFAULT), *values) == [12500.5, -5.0, 5.0, None, 7.25]


def test_price_flag(spark):
    got = apply(spark, lambda c: cleaning.price_flag(c.try_cast("double")), "12500.5", "0", None, "7.25", "-1", "10000")
    assert got == ["outlier_high", "invalid", "missing", "ok", "invalid", "ok"]


def test_brand(spark):
    got = apply(spark, cleaning.brand_name, "QingSang?Accessories Apparel", "?x", "", None, "Café �tail", " A b ")
    assert got == ["QingSang", None, None, None, "Cafe", "A b"]


def test_fold_latin(spark):
    got = apply(spark, text.fold_latin, "Crème Brûlée", "Straße Ærø", "naïve “quoted”…", "Łódź", "日本", "é", "plain")
    assert got == ["Creme Brulee", "Strasse AEro", 'naive "quoted"...', "Lodz", "日本", "e", "plain"]


def test_color_rules(spark):
    values = ["[{'Color': 'Black'}]", "[{'Color':'Red'}]", "[{'Color':   'Blue'}]", "[{'Size': 'S'}]", None]
    assert apply(spark, cleaning.color_name, *values) == ["Black", "Red", "Blue", None, None]
    assert apply(spark, lambda c: cleaning.color_name(c, True), *values) == ["Black", None, None, None, None]


def test_key_values(spark):
    got = apply(spark, lists.key_value_pairs, "[{'Color': 'Black'}, {'Material' :'Woven  Fabric'},{'E':''}]")[0]
    assert [tuple(p) for p in got] == [("Color", "Black"), ("Material", "Woven  Fabric"), ("E", "")]


def test_lists(spark):
    assert apply(spark, lists.list_elements, "['a', 'b']", "'a','a',", "", None) == [["a", "b"], ["a", "a"], [""], None]
    assert apply(spark, lambda c: lists.has_repeats(lists.list_elements(c)), "['a', 'b']", "['a','a']") == [False, True]


def test_images_modes(spark):
    values = ["['https://x/b', 'https://x/a', 'https://x/b']", "['http://x/a']", "", None]
    joined, n = (lambda c: cleaning.image_columns(c)[0]), (lambda c: cleaning.image_columns(c)[1])
    assert apply(spark, joined, *values) == ["https://x/b | https://x/a", "http://x/a", "", None]
    assert apply(spark, n, *values) == [2, 1, 0, None]
    coded = (lambda c: cleaning.image_columns(c, CODED)[0]), (lambda c: cleaning.image_columns(c, CODED)[1])
    assert apply(spark, coded[0], *values) == ["https://x/b | https://x/a", "", "", "NA"]
    assert apply(spark, coded[1], *values) == [2, 1, 1, 1]


@pytest.mark.parametrize("value, expected", [
    ("01/25/2024", "2024-01-25 00:00:00"), ("25-01-2024 09:00:00", "2024-01-25 09:00:00"),
    ("2024/01/06 10:20", "2024-01-06 10:20:00"), ("yesterday", None), ("", None), (None, None),
    ("2024-02-30", None), ("20240105", "2024-01-05 00:00:00"), ("Jan 5, 2024", "2024-01-05 00:00:00"),
    ("5 January 2024 08:09", "2024-01-05 08:09:00"), ("03/04/2024", "2024-03-04 00:00:00"),
    ("2024-01-05T10:20:30Z", "2024-01-05 10:20:30"), ("12/31/99", "1999-12-31 00:00:00"), ("marbles 5 2024", None),
    ("2024-01-05 25:00", None),
])
def test_timestamps(spark, value, expected):
    assert apply(spark, lambda c: dates.timestamp_text(dates.parse_timestamp(c)), value) == [expected]


def test_timestamp_orders_can_be_chosen(spark):
    day_first = lambda c: dates.timestamp_text(dates.parse_timestamp(c, ("dmy",)))
    assert apply(spark, day_first, "03/04/2024", "2024-01-05", "03/04/2024 10:00") == ["2024-04-03 00:00:00", None, None]


def test_white_space(spark):
    odd = "  a \t b "
    assert apply(spark, text.trim_all, odd) == ["a \t b"]
    assert apply(spark, text.squish, odd, " x \n y ") == ["a b", "x y"]
    assert apply(spark, text.has_edge_space, odd, "a", "a\n", None) == [True, False, True, None]
    assert apply(spark, text.needs_care, "plain text", "two  gaps", " x", "x ", "é", "a\tb", "") == [
        False, True, True, True, True, True, False]


def test_sanitise(spark):
    assert apply(spark, text.sanitise, "a\nb​c\u0007", "é😀", None) == ["abc", "é😀", None]
    assert apply(spark, F.length, "é😀") == [2]


def test_missing_words(spark):
    got = apply(spark, lambda c: text.is_numeric_missing(c, NUMERIC_MISSING_WORDS), "", "NA", "undefined", "0", None, "nan")
    assert got == [True, True, True, False, True, False]
    assert apply(spark, text.is_missing, "", None, "NA", " ") == [True, True, False, False]


def test_bounded_key_keeps_values_apart(spark):
    long = "x" * 100
    got = apply(spark, text.bounded_key, "a", "", None, long, long + "y")
    assert got[:3] == ["a", "", None] and got[3] != got[4] and {len(got[3]), len(got[4])} == {66}


def test_row_digest_tells_null_blank_and_boundaries_apart(spark):
    data = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("a1:b", None), ("a", "b"), ("ab", ""), ("", "ab"), ("-", None), (None, "-")]
    df = spark.createDataFrame(data, "a string, b string")
    assert df.select(text.row_digest(df, ["a", "b"])).distinct().count() == len(data)


def test_number_texts(spark):
    df = spark.createDataFrame([(1234567, 640, 2240)], "a long, n long, d long")
    row = df.select(numbers.thousands(F.col("a")), numbers.pct_text(F.col("n"), F.col("d")),
                    numbers.pct_fixed(F.col("n"), F.col("d")), numbers.pct(F.col("n"), F.lit(0))).first()
    assert tuple(row) == ("1,234,567", "28.57%", "28.6%", None)
