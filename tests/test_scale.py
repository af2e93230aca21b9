"""The skew-safe building blocks against brute force, with one key holding a third of all rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.operators import scale
from siftloom.operators.scale import (
    exact_quantiles, first_per_key, first_rows, first_selected_rows, last_per_key, long_form, rows_with_listed_key,
    top_n_per_group,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(2500)}", rng.choice([0.0, -1.5, 2.0, rng.uniform(-1e6, 1e6)]))
            for i in range(9000)]
    return data, spark.createDataFrame(data, "row_number long, k string, v double").repartition(7)


def test_first_and_last_per_key(skewed):
    data, df = skewed
    first, last = {}, {}
    for i, k, v in data:
        first.setdefault(k, (i, k, v))
        last[k] = (i, k, v)
    assert {r["k"]: tuple(r) for r in first_per_key(df, ["k"], F.col("row_number")).collect()} == first
    assert {r["k"]: tuple(r) for r in last_per_key(df, ["k"], F.col("row_number")).collect()} == last


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_rows_with_listed_key(spark, skewed, threshold, monkeypatch):
    data, df = skewed
    monkeypatch.setattr(scale, "HOT_KEYS", 3)
    counts = Counter(k for _, k, _ in data)
    expected = sorted(i for i, k, _ in data if counts[k] > 3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        listed = df.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > 3)
        got = rows_with_listed_key(df, listed, "k", "n", "row_number")
        assert got.columns == df.columns
        assert sorted(r.row_number for r in got.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_missing_keys_are_never_listed(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, ""), (4, "a")], "row_number long, k string")
    listed = df.groupBy("k").agg(F.count("*").alias("n"))
    got = rows_with_listed_key(df, listed.where("k = ''"), "k", "n", "row_number")
    assert [r.row_number for r in got.collect()] == [3]


@pytest.mark.parametrize("n", [5, 1500, 20_000])
def test_first_rows(skewed, n, monkeypatch):
    data, df = skewed
    monkeypatch.setattr(scale, "ID_BLOCK_BITS", 8)
    chosen = df.where("k <> 'hot'")
    expected = [i for i, k, _ in data if k != "hot"][:n]
    assert [r.row_number for r in first_rows(chosen, n, "row_number").collect()] == expected
    selected = chosen.select("row_number")
    assert [r.row_number for r in first_selected_rows(df, selected, n, "row_number").collect()] == expected
    monkeypatch.setattr(scale, "BROADCAST_IDS", 0)
    assert [r.row_number for r in first_selected_rows(df, selected, n, "row_number").collect()] == expected


def test_first_selected_rows_of_nothing(skewed):
    _, df = skewed
    assert first_selected_rows(df, df.where("k = 'none'").select("row_number"), 10, "row_number").count() == 0


def test_top_n_per_group(skewed):
    data, df = skewed
    counts = df.groupBy("k").agg(F.count("*").alias("count")).withColumn("g", F.when(F.col("k") == "hot", "a").otherwise("b"))
    got = top_n_per_group(counts, "g", [F.desc("count"), F.asc("k")], 40, "k").collect()
    c = Counter(k for _, k, _ in data)
    expected = sorted(((k, n) for k, n in c.items() if k != "hot"), key=lambda t: (-t[1], t[0]))[:40]
    assert sorted((r["k"], r["count"]) for r in got if r["g"] == "b") == sorted(expected)
    assert [(r["k"], r["count"]) for r in got if r["g"] == "a"] == [("hot", c["hot"])]


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 10.0], [5.0], [0.0, 0.0, 0.0], [-3.5, -3.5, 7.0], [1e-300, -1e-300, 1e300, -1e300, 0.0],
    [float(x) for x in range(1000)], [7.0] * 900 + [float(x) for x in range(100)],
    [100.0 + x * 1e-9 for x in range(500)],
])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("g", float("nan")), ("h", 1.0)], "g string, v double")
    got = {r["g"]: [r[f"q{i}"] for i in range(len(PROBS))]
           for r in exact_quantiles(df.repartition(5), "g", "v", PROBS).collect()}
    np.testing.assert_allclose(got["g"], np.quantile(values, PROBS), rtol=1e-12)
    assert got["h"] == [1.0] * len(PROBS)


def test_exact_quantiles_on_skewed_data(skewed):
    data, df = skewed
    got = exact_quantiles(df, "k", "v", [0.25, 0.5, 0.75])
    by_key: dict[str, list[float]] = {}
    for _, k, v in data:
        by_key.setdefault(k, []).append(v)
    rows = {r["k"]: [r.q0, r.q1, r.q2] for r in got.collect()}
    assert rows.keys() == by_key.keys()
    for k, vs in by_key.items():
        np.testing.assert_allclose(rows[k], np.quantile(vs, [0.25, 0.5, 0.75]), rtol=1e-12, atol=1e-12)


def test_long_form_keeps_null_and_order(spark):
    df = spark.createDataFrame([(1, "x", None)], "i long, a string, b string")
    got = long_form(df, ["a", "b"], [F.col("a"), F.upper("b")], keep=["i"])
    assert sorted(tuple(r) for r in got.select("i", "variable", F.coalesce("value", F.lit("~"))).collect()) == [
        (1, "a", "x"), (1, "b", "~")]
