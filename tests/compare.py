"""Compare the registered queries with their SQL counterparts: ``python tests/compare.py [folder] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def difference(df, con, sql: str) -> str | None:
    """None when both results agree in columns and values, else a short text."""
    mine_columns = sorted(df.columns)
    mine = [tuple(_norm(r[c]) for c in mine_columns) for r in df.collect()]
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    order = sorted(range(len(theirs_columns)), key=lambda i: theirs_columns[i])
    theirs = [tuple(_norm(r[i]) for i in order) for r in cursor.fetchall()]
    if mine_columns != sorted(theirs_columns):
        return f"columns {mine_columns} / {sorted(theirs_columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    key = lambda row: tuple((v is not None, str(type(v)), v) for v in row)
    for a, b in zip(sorted(mine, key=key), sorted(theirs, key=key)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference\n   {a}\n   {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(folder), contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(queries[name](spark, folder), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
