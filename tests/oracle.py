"""Compare a Spark result with its DuckDB oracle: names, types, rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _key(row):
    out = []
    for v in row:
        if isinstance(v, float):
            v = None if math.isnan(v) else float(f"{v:.9g}") + 0.0
        out.append((v is not None, str(v)))
    return tuple(out)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    cursor = con.execute(sql)
    theirs_names = [c[0] for c in cursor.description]
    if sorted(theirs_names) != names:
        return f"columns {names} vs {sorted(theirs_names)}"
    theirs = [tuple(row[theirs_names.index(n)] for n in names) for row in cursor.fetchall()]
    types = dict(df.dtypes)
    duck = {c[0]: str(c[1]) for c in con.execute(f"describe {sql}").fetchall()}
    wrong = {n: (types[n], duck[n]) for n in names if TYPES.get(types[n], types[n]) != duck[n]}
    ours = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    a, b = sorted(map(_key, ours)), sorted(map(_key, theirs))
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; types {wrong}; ours {a[:2]} theirs {b[:2]}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} of {len(a)} rows differ, first {diff[:2]}; names {names}"
    if wrong:
        return f"types {wrong}"
    return None
