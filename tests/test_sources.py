"""Reading, numbering, validating, previewing and writing."""

from __future__ import annotations

import pytest

from siftloom import diagnose, land_csv, number_rows, read_csv, write_bundle, write_clean
from siftloom.sources import preview
from siftloom.operators.profile import missingness_by_variable
from siftloom.sources.tables import InputError, infer_types, overflow_count, read_bundle, sample_extract, validated, write_clean_csv
from pyspark.sql import functions as F

from siftloom.operators import checks, duplicates, profile
from siftloom.operators.roles import detect_roles
from tests.conftest import SF, rows

CSV = 'a,b,c\n1,x,y\n3\n4,"",z,extra\n5,"two\nlines","say ""hi"""\n6, pad ,NA\n'


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_ragged_csv(spark, csv_file):
    table = read_csv(spark, csv_file)
    got = [tuple(r) for r in table.collect()]
    assert [g[:3] for g in got] == [("1", "x", "y"), ("3", None, None), ("4", "", "z"), ("5", "two\nlines", 'say "hi"'), ("6", "pad", None)]
    assert [g[3] for g in got] == [None, None, '4,"",z,extra', None, None]


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_other_columns(spark, tmp_path, multi_line):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n3,4,5\n")
    (folder / "b.csv").write_text("b,a\n20,10\n")
    (folder / "c.csv").write_text('a,"x.y"\n7,8\n9\n')
    table = read_csv(spark, str(folder), multi_line=multi_line)
    assert table.columns == ["a", "b", "x.y", "_overflow"]
    assert rows(table) == rows(spark.createDataFrame(
        [("1", "2", None, None), ("3", "4", None, "3,4,5"), ("10", "20", None, None), ("7", None, "8", None), ("9", None, None, None)],
        "a string, b string, xy string, o string"))
    landed = land_csv(spark, str(folder), str(tmp_path / "landed"), multi_line=multi_line)
    assert landed.count() == 5 and overflow_count(landed).first().records == 1
    assert {r.variable: r.missing_count for r in missingness_by_variable(landed).collect()}["x.y"] == 4


def test_types_come_from_all_rows(spark):
    data = [("1", "1.5", "true", "2024-01-02", "2024-01-02 03:04:05", "01", None, "x", "1")] * 50 + [("-7", "2", "F", "", None, "2", "", "y", "1e3")]
    got = infer_types(spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string, g string, h string, i string"))
    assert [t for _, t in got.dtypes] == ["bigint", "double", "boolean", "date", "timestamp_ntz", "string", "string", "string", "double"]
    assert got.where("a = -7 and b = 2 and not c and d is null and i = 1000").count() == 1


def test_given_columns(spark, csv_file):
    assert read_csv(spark, csv_file, columns=["p", "q", "r"]).columns == ["p", "q", "r", "_overflow"]


def test_missing_file(spark):
    with pytest.raises(InputError, match="not found"):
        read_csv(spark, "/no/such/file.csv")


def test_validation(spark):
    with pytest.raises(InputError, match="no rows"):
        validated(spark.createDataFrame([], "a string"))
    with pytest.raises(InputError, match="no columns"):
        validated(spark.createDataFrame([], ""))


def test_land_csv_numbers_rows_in_file_order(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for f in range(5):
        lines = [f"{f}-{i}" for i in range(50 * (5 - f))]
        (folder / f"part-{f}.csv").write_text("v\n" + "\n".join(lines) + "\n")
        expected += lines
    landed = land_csv(spark, str(folder), str(tmp_path / "landed"))
    assert [(r.row_number, r.v) for r in landed.orderBy("row_number").collect()] == list(enumerate(expected, 1))


def test_number_rows_on_split_files(spark, tmp_path):
    spark.range(60_000).write.option("parquet.block.size", "65536").parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = number_rows(spark.read.parquet(str(tmp_path / "t")))
        assert [r.row_number for r in got.orderBy("row_number").collect()] == list(range(1, 60_001))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_number_rows_on_computed_tables(spark):
    got = number_rows(spark.range(1000).repartition(7).selectExpr("id % 10 AS k"), from_files=False)
    assert sorted(r.row_number for r in got.collect()) == list(range(1, 1001))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "", 'q"uote'), (3, "l1\nl2", "é")], "row_number long, x string, y string")
    write_clean_csv(df, str(tmp_path / "out"))
    got = [tuple(r)[:3] for r in read_csv(spark, str(tmp_path / "out")).collect()]
    assert sorted(got) == [("1", "a", None), ("2", None, 'q"uote'), ("3", "l1\nl2", "é")]


def test_write_clean(spark, catalog, tmp_path):
    write_clean(catalog, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c/parquet")).count() == catalog.count()
    assert read_csv(spark, str(tmp_path / "c/csv")).count() == catalog.count()


def test_bundle(spark, catalog, tmp_path):
    tables = {k: v for k, v in diagnose(catalog).items() if k in ("overview", "problem_rows", "url_checks")}
    write_bundle(tables, str(tmp_path / "bundle"))
    back = read_bundle(spark, str(tmp_path / "bundle"), list(tables))
    assert rows(back["overview"]) == rows(tables["overview"])
    assert back["problem_rows"].count() == tables["problem_rows"].count() > 0
    assert back["problem_rows"].where("name like '%\n%'").count() == 0


def test_every_table_can_be_diagnosed(spark):
    for name in ("customer", "events", "documents"):
        df = spark.read.parquet(f"{SF}/{name}.parquet").withColumn("row_number", F.monotonically_increasing_id()).limit(50)
        tables = diagnose(df)
        assert {k for k, t in tables.items() if t.columns} == set(tables) and len(tables) == 20
        assert all(tables[k].count() == 0 for k in ("attr_names", "attr_name_values", "image_dup_summary"))


def test_no_limit_unless_asked(spark):
    df = spark.range(1, 120_001).selectExpr("id AS row_number", "'u' AS url", "CAST(-1 AS STRING) AS price", "CAST(id AS STRING) AS size")
    roles = detect_roles(df)
    assert duplicates.repeated_key_rows(df, "url").count() == checks.problem_rows(df, roles).count() == 120_000
    assert profile.level_summary(df, ["size"]).count() == sample_extract(df).count() == 120_000
    assert duplicates.repeated_key_rows(df, "url", n=0).count() == checks.problem_rows(df, roles, n=0).count() == 0
    assert [r.row_number for r in duplicates.exact_duplicate_rows(df.drop("size"), n=3).collect()] == [1, 2, 3]


def test_sample_extract(catalog):
    sample = sample_extract(catalog, 20)
    assert sample.count() == 20 and sample.where("name like '%\n%'").count() == 0


def test_preview(spark, catalog):
    got = preview.preview(catalog)
    assert got["head"].count() == 3
    assert [r.variable for r in got["summary"].collect()] == [c for c in catalog.columns if c != "row_number"]
    numbers = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, None)], "row_number long, v double, s string")
    assert [tuple(r) for r in preview.column_summary(numbers).collect()] == [
        ("v", "double", 2, 0, 2.0, 2.5, 3.0, 3.0, 3.5, 4.0), ("s", "string", 2, 1, None, None, None, None, None, None)]
