"""Spark rows against DuckDB rows, as multisets of normalised values."""

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def duck(sql, sf=SF):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in r.fetchall())


def sparked(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
