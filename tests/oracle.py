"""Compare a registered query with its SQL in DuckDB: names, rows, values (doubles to 6 places), in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if glob.glob(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' if both agree, else what differs."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    a, b = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(rel.columns, rel.fetchall())
    if len(a) != len(b):
        one, other = set(a), set(b)
        return f"{len(a)} and {len(b)} rows; first {[x for x in a if x not in other][:2]}, {[x for x in b if x not in one][:2]}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} of {len(a)} rows differ: {bad[:2]}" if bad else ""
