"""Sketches that merge, votes on date orders, counters on the write, and folders that go."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import functions as F

from siftloom import remove_scratch, write_counted
from siftloom.functions.dates import parse_timestamp
from siftloom.operators import checks, sketches
from siftloom.operators.ranges import range_checks
from siftloom.plans import clean as clean_plan
from siftloom.settings import CODED, DATE_ORDERS, DEFAULT
from siftloom.sources import scratch
from siftloom.sources.identity import number_placed, pin
from tests.conftest import rows


def test_ranges_from_sketches_of_parts(spark, tmp_path):
    folder = str(tmp_path / "sketches")
    whole = spark.range(60_000).selectExpr("id AS row_number", "CASE WHEN id % 50 = 0 THEN -power(id, 1.5) WHEN id % 9 > 0 THEN (id * 7919) % 10007 END AS price",
                                           "CAST(id % 3 AS string) AS rating", "'x' AS weight")
    for k in range(6):  # a day at a time; only its own rows are read
        sketches.range_sketches(whole.where(F.col("row_number") % 6 == k)).write.mode("append").parquet(folder)
    got = {r.variable: r for r in sketches.range_checks_from(spark.read.parquet(folder)).collect()}
    want = {r.variable: r for r in range_checks(whole).collect()}
    assert set(got) == set(want) == {"price", "rating"}
    for name, w in want.items():
        g = got[name]
        for exact in ("original_type", "parsed_count", "parsed_pct", "min", "max", "negative_count", "zero_count"):
            assert g[exact] == w[exact]
        assert abs(g["mean"] - w["mean"]) < 1e-6 * (1 + abs(w["mean"]))
        values = np.sort(np.array([float(r[0]) for r in whole.select(name).where(f"{name} IS NOT NULL").collect()]))
        for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            low, high = np.searchsorted(values, g[q], "left") / len(values), np.searchsorted(values, g[q], "right") / len(values)
            assert low - sketches.KLL_RANK_ERROR <= p <= high + sketches.KLL_RANK_ERROR
        assert abs(g.iqr_outlier_count - w.iqr_outlier_count) <= (sketches.KLL_RANK_ERROR + 2 / sketches.GRID) * w.parsed_count
    # A table without numbers, and an empty one, have rows in no result.
    assert sketches.range_checks_from(sketches.range_sketches(whole.limit(0))).count() == 0
    assert [r.parsed_count for r in sketches.range_sketches(whole.limit(0), columns=["price"]).collect()] == []


def test_distinct_values_and_overlap(spark):
    a = spark.range(5_000).selectExpr("CAST(id AS string) AS k", "CAST(id % 10 AS int) AS g", "CASE WHEN id % 2 = 0 THEN '' ELSE 'x' END AS b")
    b = spark.range(4_000, 90_000).selectExpr("CAST(id AS string) AS k", "CAST(id % 20 AS int) AS g", "'y' AS b")
    one, other = (sketches.distinct_sketches(df, ["k", "g", "b"]) for df in (a, b))
    got = {r.variable: (r.present, r.unique_count) for r in sketches.distinct_from(one.unionByName(other)).collect()}
    assert got["g"] == (91_000, 20) and got["b"] == (2_500 + 86_000, 2) and got["k"][0] == 91_000
    assert abs(got["k"][1] - 90_000) < 4 * sketches.THETA_ERROR * 90_000
    both = {r.variable: r for r in sketches.overlap(one, other).collect()}
    assert (both["g"].one, both["g"].other, both["g"].both, both["g"].either) == (10, 20, 10, 20)
    assert both["k"].one == 5_000 and abs(both["k"].both - 1_000) < 0.15 * 1_000 and both["b"].both == 0


def test_columns_elect_their_date_orders(spark):
    texts = ["13/02/2024", "03/02/2024", "28/12/2023 10:00", "01/25/2024", "2024-05-06", "soon", None, "04/05/2024 07:08:09"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    votes = [tuple(r) for r in checks.date_order_votes(df, "t").collect()]
    assert votes == [("dmy", 4, 2), ("mdy", 3, 1), ("ymd", 1, 1)]
    cfg = checks.elected_orders(df, "t")
    got = {r.t: str(r.at) for r in df.select("t", parse_timestamp(F.col("t"), cfg.date_orders).alias("at")).collect()}
    assert got["03/02/2024"] == "2024-02-03 00:00:00" and got["13/02/2024"] == "2024-02-13 00:00:00" and got["01/25/2024"] == "2024-01-25 00:00:00"
    assert got["04/05/2024 07:08:09"] == "2024-05-04 07:08:09" and got["2024-05-06"] == "2024-05-06 00:00:00" and got["soon"] == "None"
    listed = {r.t: str(r.at) for r in df.select("t", parse_timestamp(F.col("t")).alias("at")).collect()}
    assert listed["03/02/2024"] == "2024-03-02 00:00:00"  # the listed rule, as before
    # Without votes, or with equally many, the listed order stays.
    assert checks.elected_orders(df.limit(0), "t") == DEFAULT and set(cfg.date_orders) == set(DATE_ORDERS)


def test_counters_ride_on_the_write(spark, catalog, tmp_path):
    for cfg in (DEFAULT, CODED):
        folder = str(tmp_path / cfg.mode)
        got = write_counted(catalog, folder, cfg=cfg)
        assert rows(got) == rows(clean_plan.run_counters(catalog, cfg=cfg))
        table = clean_plan.clean(catalog, cfg=cfg).table
        assert spark.read.parquet(folder).columns == table.columns
        assert rows(spark.read.parquet(folder)) == rows(table)
    bare = write_counted(catalog.select("row_number", "price"), str(tmp_path / "bare"))
    assert {r.counter: r.value for r in bare.collect()}["duplicate_rows_removed"] == 0


def test_scratch_folders_go(spark):
    table = pin(spark.range(10).toDF("v"))
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    assert os.path.isdir(folder) and table.count() == 10
    assert remove_scratch(spark) >= 1 and not os.path.exists(folder)
    assert remove_scratch(spark) == 0 and scratch.new_folder(spark) != scratch.new_folder(spark)
    remove_scratch(spark)


def test_rows_are_numbered_by_place(spark):
    df = spark.range(500).selectExpr("concat('f', id % 3) AS file", "id % 7 AS start", "id AS at", "id AS v").repartition(9)
    got = [r.v for r in number_placed(df).orderBy("row_number").collect()]
    assert got == sorted(range(500), key=lambda i: (i % 3, i % 7, i))
    assert [r.row_number for r in number_placed(df).orderBy("row_number").collect()] == list(range(1, 501))
