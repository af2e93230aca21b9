from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", f"file://{shared}").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def catalog(spark):
    from siftloom.catalog.view import catalog as view

    return view(spark, SF)


def rows(df):
    """Rows as tuples, sorted with NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
