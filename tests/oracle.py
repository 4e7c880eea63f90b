"""Run queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(_cell(v) for v in value) + "]"
    return repr(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, query, sf_dir) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    df = query.build(spark, sf_dir)
    mine = normalised(df.columns, df.collect())
    if query.sql is None:
        return [] if mine[1] else ["no rows"]
    result = con.execute(query.sql)
    theirs = normalised([c[0] for c in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return [f"columns {mine[0]} and {theirs[0]}"]
    if len(mine[1]) != len(theirs[1]):
        return [f"{len(mine[1])} and {len(theirs[1])} rows", *[str(x) for x in mine[1][:2]], *[str(x) for x in theirs[1][:2]]]
    different = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    return [f"{len(different)} rows differ"] * bool(different) + [f"{a}\n   {b}" for a, b in different[:3]]
