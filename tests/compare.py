"""Runs a query and its DuckDB twin over the same tables and compares all rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, plain(x)) for k, x in v.asDict().items())
    if type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    if isinstance(v, bool) or v is None:
        return v
    return str(v) if not isinstance(v, (int, str)) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def difference(df, con, sql):
    """None when both give the same columns and rows, else a message."""
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    theirs = rows_of(names, rel.fetchall())
    ours = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if ours != theirs:
        a, b = [x for x in ours if x not in set(theirs)][:3], [x for x in theirs if x not in set(ours)][:3]
        return f"{len(ours)} against {len(theirs)} rows; only ours {a}; only theirs {b}"
    return None
