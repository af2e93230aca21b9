"""The run in four scans against the run that reads the source per table."""

from __future__ import annotations

import pytest

from siftloom import diagnose, write_bundle
from siftloom.plans import bundle
from siftloom.settings import CODED, DEFAULT
from siftloom.sources.tables import read_bundle
from tests.conftest import SF, rows


def shown(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(df)]


@pytest.mark.parametrize("cfg", [DEFAULT, CODED], ids=["intent", "coded"])
def test_tables_are_equal_and_scans_are_few(spark, catalog, tmp_path, monkeypatch, cfg):
    source = str(tmp_path / "source")
    catalog.write.parquet(source)
    df, scans = spark.read.parquet(source), []
    pin = bundle.pin

    def counting(table, by=None):
        scans.append(table._jdf.queryExecution().executedPlan().toString().count("FileScan parquet"))
        return pin(table, by)

    monkeypatch.setattr(bundle, "pin", counting)
    tables = bundle.diagnose_stored(df, cfg=cfg)
    want = diagnose(df, cfg=cfg)
    assert list(tables) == list(want) and len(tables) == 20
    for name in want:
        assert tables[name].columns == want[name].columns, name
        assert shown(tables[name]) == shown(want[name]), name
        assert source not in tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert not any(source in f for f in tables[name].inputFiles()), name
    # The row tables' pass reads the short lists of repeated keys, which are no source, beside the source.
    assert len(scans) == 4 and sum(scans) == 6


@pytest.mark.parametrize("name", ["customer", "events", "documents", "lineitem"])
def test_other_tables(spark, name):
    df = spark.read.parquet(f"{SF}/{name}.parquet").limit(200).selectExpr("row_number() over (order by 1) AS row_number", "*")
    tables, want = bundle.diagnose_stored(df), diagnose(df)
    for k in want:
        assert tables[k].columns == want[k].columns and shown(tables[k]) == shown(want[k]), k


def test_empty_and_long_lists(spark, catalog, monkeypatch, tmp_path):
    empty = bundle.diagnose_stored(catalog.limit(0))
    assert {k: v.count() for k, v in empty.items()} == {k: v.count() for k, v in diagnose(catalog.limit(0)).items()}
    monkeypatch.setattr(bundle, "BROADCAST_IDS", 0)
    tables = bundle.diagnose_stored(catalog)
    want = diagnose(catalog)
    for k in ("exact_dup_rows", "dup_url_rows", "problem_rows", "numeric_parse_issues"):
        assert shown(tables[k]) == shown(want[k])
    write_bundle({k: tables[k] for k in ("overview", "url_checks")}, str(tmp_path / "b"))
    assert shown(read_bundle(spark, str(tmp_path / "b"), ["overview"])["overview"]) == shown(want["overview"])


def test_values_of_a_file_in_one_piece_are_counted_in_several_tasks(spark, catalog, tmp_path):
    """Counting neither sorts all rows nor leaves them to the task that scanned them."""
    source = str(tmp_path / "piece")
    catalog.coalesce(1).write.parquet(source)
    df = spark.read.parquet(source)
    n = df.count()
    values = bundle.counted_values(df, bundle.detect_roles(df), DEFAULT, 5 * bundle.TASK_ROWS)
    assert "SortAggregate" not in values._jdf.queryExecution().executedPlan().toString()
    assert rows(values) == rows(bundle.counted_values(df, bundle.detect_roles(df), DEFAULT))
    sizes = bundle.dealt(df, 5 * bundle.TASK_ROWS).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert len(sizes) == 5 and sum(sizes) == n and max(sizes) < n / 2
    assert bundle.dealt(df, 10 ** 9).rdd.getNumPartitions() == bundle.TASKS
