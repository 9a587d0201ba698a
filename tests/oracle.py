"""Comparison of a query with its SQL in DuckDB on the same tables."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(folder + "/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def shown(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(shown, v)) + "]"
    return f"{float(v):.6g}" if isinstance(v, float) or hasattr(v, "quantize") else str(v)


def differences(con, df, sql):
    got, result = df.collect(), con.execute(sql)
    names, want = [d[0] for d in result.description], result.fetchall()
    columns = sorted(df.columns)
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    a, b = sorted(tuple(shown(r[c]) for c in columns) for r in got), sorted(tuple(shown(r[i]) for i in at) for r in want)
    return [] if a == b else [x for x in a if x not in b][:3] + [x for x in b if x not in a][:3] or ["other multiplicities"]
