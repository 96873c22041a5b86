"""A Spark result beside the rows DuckDB computes from the same Parquet files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every table of the folder as a view."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs as multisets of rows, or None. Columns are compared by name."""
    expected = con.execute(sql)
    names = sorted(c[0] for c in expected.description)
    if names != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {names}"
    order = [[c[0] for c in expected.description].index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    got = Counter(tuple(row) for row in result.select(*names).collect())
    if want == got:
        return None
    extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{sum(got.values())} rows, expected {sum(want.values())}; extra {extra}; missing {lost}"
