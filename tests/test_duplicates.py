"""Rows that repeat, keys that are blank, and columns named like helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftloom.operators import cleaning, duplicates, extensions, scale
from siftloom.operators.ranges import range_checks
from siftloom.settings import CODED, Settings
from tests.conftest import rows


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame([(1, "", 1), (2, "", 2), (3, None, 3), (4, "k1", 4), (5, "k1", 5), (6, "SKU: ", 6), (7, "SKU:k1", 7)],
                               "row_number long, sku string, __key int")
    assert [r.row_number for r in duplicates.keep_first_per_key(df, "sku").orderBy("row_number").collect()] == [1, 2, 3, 4, 6, 7]
    kept = cleaning.clean_sku(df)[0]
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.orderBy("row_number").collect()] == [(1, "", 1), (2, "", 2), (3, None, 3), (4, "k1", 4), (6, "", 6)]
    assert [r.row_number for r in cleaning.clean_sku(df, CODED)[0].orderBy("row_number").collect()] == [1, 3, 4]


def test_helper_names_do_not_touch_columns(spark):
    names = ["__key", "__digest", "__hot", "__meet", "__cold", "__h", "__price", "__d", "__bits", "__bucket"]
    df = spark.createDataFrame([(i, f"k{i % 4 if i < 6 else i}", "5", *([i] * len(names))) for i in range(9)],
                               "row_number long, k string, price string, " + ", ".join(f"`{n}` int" for n in names))
    for got in (duplicates.keep_first_per_key(df, "k"), duplicates.drop_exact_duplicates(df), duplicates.repeated_key_rows(df, "k"),
                duplicates.exact_duplicate_rows(df.drop("row_number").withColumn("row_number", F.lit(1)).select(*df.columns))):
        assert got.columns == df.columns
        assert all(r[n] == (r["row_number"] if "row_number" in r and r["row_number"] != 1 else r[n]) for r in got.collect() for n in names)
    assert sorted(r.row_number for r in duplicates.repeated_key_rows(df, "k").collect()) == [0, 1, 4, 5]
    assert extensions.clean_discount(df.withColumnRenamed("price", "discount")).select(*names).collect() == df.select(*names).collect()


@pytest.mark.parametrize("few", [True, False])
def test_rows_that_may_repeat(spark, monkeypatch, few):
    if not few:  # the list of hashes is taken as too long, a bitmap stands for it
        monkeypatch.setattr(scale, "BROADCAST_IDS", 0)
        monkeypatch.setattr(scale, "BITMAP_BITS", 17)
    df = spark.range(40_000).selectExpr("id AS row_number", "CASE WHEN id < 300 THEN id % 100 WHEN id % 3 = 0 THEN NULL ELSE id END AS k")
    got = duplicates.repeated_key_rows(df, "k")
    assert sorted(r.row_number for r in got.collect()) == list(range(300))
    near = scale.rows_that_may_repeat(df.where("k IS NOT NULL"), F.col("k").cast("string"))
    assert 300 <= near.count() < 600 and near.columns == df.columns
    one = spark.range(1000).selectExpr("id AS row_number", "'x' AS k")
    assert duplicates.repeated_key_rows(one, "k").count() == 1000
    assert duplicates.repeated_key_rows(df.limit(0), "k").count() == 0


def shuffled_bytes(spark, run):
    """Bytes that a run writes for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext.setJobGroup("measured", "")
    run()
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("measured") for s in (tracker.getJobInfo(job).stageIds or [])}
    total = 0
    for s in stages:
        try:
            total += store.lastStageAttempt(s).shuffleWriteBytes()
        except Exception:  # skipped stages are not kept
            pass
    spark.sparkContext.setJobGroup("other", "")
    return total


def test_few_repeats_move_few_bytes(spark, tmp_path):
    """One row in a thousand has a copy: less than 2 per cent of the rows' bytes are shuffled."""
    wide = F.concat(*[F.sha2(F.concat_ws("-", F.lit(i), F.when(F.col("id") % 1000 == 999, F.col("id") - 1).otherwise(F.col("id"))), 512) for i in range(12)])
    spark.range(40_000).select(F.col("id").alias("row_number"), wide.alias("text")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = []
    moved = shuffled_bytes(spark, lambda: found.extend(duplicates.exact_duplicate_rows(df).collect()))
    assert len(found) == 80
    assert 0 < moved < 0.02 * 40_000 * 12 * 128


def test_range_checks_move_no_values(spark, tmp_path):
    """What is shuffled are counts per bucket and task, which are bounded: eight times the rows move some two times as much."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with input that is too large to be sent whole
    moved = []
    try:
        for n in (100_000, 800_000):
            path = str(tmp_path / str(n))
            spark.range(n).selectExpr("id AS row_number", "id % 977 * 1.5 AS price", "CAST(id * 7919 % 100003 AS double) AS amount").repartition(8).write.parquet(path)
            df, got = spark.read.parquet(path), {}
            moved.append(shuffled_bytes(spark, lambda: got.update({r.variable: r for r in range_checks(df).collect()})))
            assert got["price"].median == sorted(i % 977 * 1.5 for i in range(n))[n // 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert 0 < moved[1] < 3 * moved[0]


def test_imputed_columns_keep_their_types(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 10), ("a", None, None, 11), ("a", 2, 2.0, None), ("b", None, None, None)], "g string, i int, d double, l long")
    got = extensions.impute_by_group(df, "g", ["i", "d", "l"])
    assert dict(got.dtypes)["i"] == "int" and dict(got.dtypes)["d"] == "double" and dict(got.dtypes)["l"] == "bigint"
    assert rows(got.select("g", "i", "d", "l")) == [("a", 1, 1.0, 10), ("a", 2, 1.5, 11), ("a", 2, 2.0, 11), ("b", None, None, None)]
    assert Settings().mode == "intent"


def test_gaps_fall_back_from_level_to_level(spark):
    data = [("a", "x", 1, 1.0, "red"), ("a", "x", 2, None, None), ("a", "y", 3, 5.0, "blue"), ("a", "y", None, None, ""), ("a", "z", None, None, None),
            ("b", "x", None, None, None), (None, "x", 7, 7.0, "red"), (None, "x", None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "row_number long, g string, h string, n int, d double, t string")
    got = {r.row_number: r for r in extensions.impute_by_levels(df, [["g", "h"], ["g"], []], ["n", "d", "t"]).collect()}
    assert (got[1].d, got[1].d_imputed_from, got[1].t, got[1].n, got[1].n_imputed) == (1.0, "g h", "red", 2, False)
    assert (got[3].n, got[3].d, got[3].t, got[3].t_imputed_from) == (3, 5.0, "blue", "g h")
    assert (got[4].n, got[4].d, got[4].d_imputed_from, got[4].t) == (2, 3.0, "g", "blue")
    assert (got[5].n, got[5].d, got[5].d_imputed_from, got[5].t) == (3, 5.0, "all", "red")
    assert (got[7].n, got[7].n_imputed_from, got[0].n_imputed_from) == (7, "g h", None)
    plan = {r.variable: r.decision for r in extensions.imputation_plan(df, exclude_pct=60.0).collect()}
    assert plan == {"g": "impute", "h": "keep", "n": "document", "d": "exclude", "t": "exclude"}
