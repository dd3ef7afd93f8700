"""Run a query in Spark and its SQL in DuckDB and compare rows without regard to order."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return float(x) if isinstance(x, decimal.Decimal) else str(x) if isinstance(x, list | dict) else x


def rows_of(columns, rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if both agree in columns and rows."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection(sf_dir).execute(sql)
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if got != want:
        a, b = [x for x in got if x not in set(want)][:4], [x for x in want if x not in set(got)][:4]
        return f"{len(got)} and {len(want)} rows; Spark only {a}, SQL only {b}"
    return ""
