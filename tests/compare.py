"""Rows of a Spark result and of its SQL, in a form that can be compared."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _sorted([tuple(r) for r in df.select(*columns).collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [names[i] for i in order], _sorted(rows)
