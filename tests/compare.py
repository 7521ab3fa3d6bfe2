"""Runs a query in Spark and its SQL in DuckDB and compares columns and values, row order aside."""

from __future__ import annotations

import decimal
import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(x):
    if isinstance(x, decimal.Decimal):
        return f"decimal {x}"
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    return x


def _kind(x) -> str:
    return type(x).__name__


def differences(frame, con, sql: str) -> list[str]:
    names = sorted(frame.columns)
    got = [tuple(_plain(row[n]) for n in names) for row in frame.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return [f"columns: {names} against {sorted(columns)}"]
    at = [columns.index(n) for n in names]
    expected = [tuple(_plain(row[i]) for i in at) for row in cursor.fetchall()]
    out = []
    if len(got) != len(expected):
        out.append(f"rows: {len(got)} against {len(expected)}")
    for i, name in enumerate(names):
        kinds = [{_kind(row[i]) for row in rows if row[i] is not None} for rows in (got, expected)]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1]:
            out.append(f"type of {name}: {kinds[0]} against {kinds[1]}")
    order = [sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r)) for rows in (got, expected)]
    wrong = [(a, b) for a, b in zip(*order, strict=False) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ in {names}, first: {wrong[0][0]} against {wrong[0][1]}")
    return out
