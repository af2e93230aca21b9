"""CSV files with line ends inside quotes, read in pieces, against the reader that takes a file as a whole."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from siftloom import land_csv, read_csv
from siftloom.sources.quoted_csv import open_pieces, physical_lines, records, survey
from siftloom.sources.tables import InputError, header_names
from tests.conftest import rows


@pytest.fixture
def small_pieces(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def field(rnd, end):
    kind = rnd.random()
    body = "".join(rnd.choice(["a", "bc", " ", "é", "x y", "1"]) for _ in range(rnd.randint(0, 5)))
    if kind < 0.45:
        return body
    if kind < 0.6:
        return body + rnd.choice(['5" wide', 'say "hi"', "'q'"]) if body.strip() else "z"
    inner = "".join(rnd.choice(["a", '""', ",", end, end + end, " ", "long text " * 3, "é"]) for _ in range(rnd.randint(0, 8)))
    return rnd.choice(["", " "]) + '"' + inner + '"' + rnd.choice(["", " "])


def random_file(rnd, end, lines):
    out = ["a,b,c"]
    for _ in range(lines):
        out.append(",".join(["k" + str(rnd.randint(0, 99)), *(field(rnd, end) for _ in range(rnd.choice([1, 2, 2, 2, 3])))]))
        if rnd.random() < 0.05:
            out.append("")
    return end.join(out) + rnd.choice(["", end])


@pytest.mark.parametrize("seed", range(6))
def test_pieces_give_what_one_task_gives(spark, tmp_path, small_pieces, seed):
    rnd = random.Random(seed)
    end = "\r\n" if seed % 3 == 2 else "\n"
    path = tmp_path / "in.csv"
    path.write_bytes((b"\xef\xbb\xbf" if seed == 1 else b"") + random_file(rnd, end, 250).encode())
    lines = physical_lines(spark, str(path))
    assert survey(lines).first().kind == "quoted"
    pieces = open_pieces(lines)
    assert pieces.count() > 20 and pieces.where("inside").count() > 0
    whole = read_csv(spark, str(path), one_task=True)
    got = read_csv(spark, str(path))
    assert got.columns == whole.columns == ["a", "b", "c", "_overflow"]
    # Spark's reader keeps the text of a whole record for the overflow with line ends as they are.
    assert rows(got) == rows(whole)
    assert read_csv(spark, str(path)).rdd.getNumPartitions() > 1


def test_records_of_many_shapes(spark, tmp_path, small_pieces):
    folder = tmp_path / "in"
    folder.mkdir()
    long = "line\n" * 400 + 'with ""quotes"", commas,\n' * 50
    (folder / "a.csv").write_text(f'k,t\n1,"{long}"\n2,"x"\n3,"tail\n')
    (folder / "b.csv").write_text("t,k\nplain,4\n" + "".join(f"w{i},{i}\n" for i in range(5, 200)))
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text('\n \nk,"two\nlines","two\nlines",K,,_overflow\nd7,"a\nb",c,d,e,f,g\n')
    got = read_csv(spark, str(folder))
    assert got.columns == ["k", "t", "two\nlines", "two\nlines_2", "K_2", "V5", "_overflow_2", "_overflow"]
    by = {r.k: r for r in got.collect()}
    assert len(by) == 200 and by["1"].t == long.replace('""', '"') and by["2"].t == "x" and by["4"].t == "plain"
    assert tuple(by["d7"])[2:] == ("a\nb", "c", "d", "e", "f", 'd7,"a\nb",c,d,e,f,g')
    assert by["3"].t.strip().strip('"') == "tail"


def test_rows_are_numbered_in_file_order(spark, tmp_path, small_pieces):
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for name, head in (("a", "k,t"), ("b", "t,k"), ("c", "k,t,u")):
        keys = [f"{name}{i}" for i in range(120)]
        want += keys
        text = "\n".join("x,{0}".format(k) if name == "b" else f'{k},"l\n{k}"' if name == "a" and int(k[1:]) % 3 == 0 else f"{k},y" for k in keys)
        (folder / f"{name}.csv").write_text(f"{head}\n{text}\n")
    landed = land_csv(spark, str(folder), str(tmp_path / "landed"))
    assert [(r.row_number, r.k) for r in landed.orderBy("row_number").collect()] == list(enumerate(want, 1))


def test_headers(spark, tmp_path):
    assert header_names('﻿ a ,b,,B,"x\ny"') == ["a", "b", "V3", "B_2", "x\ny"]
    assert header_names("x,x,x_2") == ["x", "x_2", "x_2_2"]
    path = tmp_path / "blank.csv"
    path.write_text("\n\r\n  \na,b\n1,2\n")
    assert rows(read_csv(spark, str(path))) == [("1", "2", None)]
    path.write_text('"x\nz",y\n1,2\n3,4,5\n')
    got = read_csv(spark, str(path))
    assert got.columns == ["x\nz", "y", "_overflow"] and rows(got) == [("1", "2", None), ("3", "4", "3,4,5")]
    path.write_text("a,b\n1,2\na,b\n")
    assert rows(read_csv(spark, str(path))) == [("1", "2", None), ("a", "b", None)]
    old = tmp_path / "old.csv"
    old.write_bytes(b"a,b\r1,2\r3,4\r")
    assert rows(read_csv(spark, str(old))) == [("1", "2", None), ("3", "4", None)]
    path.write_text("")
    with pytest.raises(InputError, match="no rows"):
        land_csv(spark, str(path), str(tmp_path / "none"))


def test_standard_writer_comes_back(spark, tmp_path, small_pieces):
    rnd = random.Random(9)
    data = [[f"r{i}", *("".join(rnd.choice(['"', ",", "\n", "a", "é", "bb", "'"]) for _ in range(rnd.randint(1, 30))) + "." for _ in range(3))] for i in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["k", "x", "y", "z"], *data])
    path = tmp_path / "w.csv"
    path.write_text(out.getvalue())
    got = {r.k: [r.x, r.y, r.z] for r in read_csv(spark, str(path)).collect()}
    assert got == {d[0]: d[1:] for d in data}
    assert records(spark, str(path)).where("header").count() == 1


def test_no_python_and_no_single_task(spark, tmp_path, small_pieces):
    path = tmp_path / "in.csv"
    path.write_text("k,t\n" + "".join(f'{i},"a\nb"\n' for i in range(500)))
    plan = read_csv(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
    sizes = physical_lines(spark, str(path)).groupBy("file", "start").count().agg(F.max("count")).first()[0]
    assert sizes < 100
