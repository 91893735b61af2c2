"""Run a registered query and its SQL twin on the same tables and compare all rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    theirs = normal(sql_columns, result.fetchall())
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if sorted(df.columns) != sorted(sql_columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(sql_columns)}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            found.append(f"{str(a)[:400]} != {str(b)[:400]}")
            if len(found) > 3:
                break
    return found
