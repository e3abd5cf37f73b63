"""Run a Spark query and its DuckDB oracle side by side (test helper)."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)


def compare(df, con, sql):
    """Returns (ok, message)."""
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(sr)} rows match"
