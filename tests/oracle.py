"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
    "string": "text", "varchar": "text", "double": "float", "float": "float", "boolean": "boolean", "date": "date",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(folder) / (name + '.parquet')}')")
    return con


def _plain(x: object) -> object:
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in words; empty when schema and all values are equal."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    types = {r[0]: r[1].lower() for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = _rows(df.columns, df.collect())
    problems = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    for name, type_ in df.dtypes:
        if KINDS.get(type_.lower(), type_) != KINDS.get(types[name], types[name]):
            problems.append(f"type of {name}: {type_} against {types[name]}")
        elif type_.lower() != {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}.get(types[name], types[name]):
            problems.append(f"(width of {name}: {type_} against {types[name]})")
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems
