"""Spark rows and DuckDB rows of a query, made comparable."""

import math
import os

import duckdb

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows(query, sql, spark, folder=SMALL):
    df = query(spark, folder)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    mine = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    other = sorted(tuple(cell(r[names.index(c)]) for c in columns) for r in result.fetchall())
    return mine, other
