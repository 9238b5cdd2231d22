"""The given tables in DuckDB, and row sets that compare equal across engines."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in data)


def same(df, sql, con):
    a = rows(df.columns, df.collect())
    r = con.sql(sql)
    b = rows(r.columns, r.fetchall())
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    assert a[1] == b[1]
