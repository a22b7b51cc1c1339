"""Compare registered queries with their SQL in DuckDB, as sets of rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


#: Types of scalar columns that must be the same in both engines.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "float", "HUGEINT": "none", "SMALLINT": "smallint", "TINYINT": "tinyint"} | {f"DECIMAL({p},{s})": "none" for p in range(1, 39) for s in range(p + 1)}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({files})")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if hasattr(x, "tolist") and not isinstance(x, (str, bytes)):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return tuple(_cell(v) for v in x)
    if isinstance(x, dict):
        return tuple(sorted((k, _cell(v)) for k, v in x.items()))
    if hasattr(x, "asDict"):
        return _cell(x.asDict())
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def differences(spark, con, name, query, sql, sf_dir):
    """None if equal, else a short account."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns {sorted(df.columns)} and {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if TYPES.get(kinds[c], t) != t]
    if odd:
        return f"{name}: types {odd}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want, strict=False) if a != b][:2]
        return f"{name}: {len(got)} and {len(want)} rows; {odd}"
    return None
