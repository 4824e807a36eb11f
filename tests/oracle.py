"""Runs a catalogue query in Spark and its SQL in DuckDB and compares rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


_KIND = {bool: "bool", int: "int", float: "float", str: "str"}


def kinds(rows: list[tuple]) -> list[set]:
    width = len(rows[0]) if rows else 0
    return [{_KIND.get(type(r[i]), type(r[i]).__name__) for r in rows if r[i] is not None} for i in range(width)]


def compare(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    result = con.execute(sql)
    their_columns = [d[0] for d in result.description]
    theirs = _rows(their_columns, result.fetchall())
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(spark_df.columns) != sorted(their_columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(their_columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)}"
    if kinds(ours) != kinds(theirs):
        return f"types {kinds(ours)} / {kinds(theirs)} of {sorted(their_columns)}"
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if differing:
        return f"{len(differing)} of {len(ours)} rows differ in {sorted(their_columns)}: {differing[0]}"
    if not ours:
        return "no rows"
    return None
