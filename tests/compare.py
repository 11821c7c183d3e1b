"""Run a registered query and its SQL twin and compare the rows."""

from __future__ import annotations

import math
from glob import glob
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_cell(row[i]) for i in order]) for row in rows)


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], list[str]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])
