"""Runs a query and its SQL over the same tables and compares their rows."""

import math
import os
from collections import Counter

import duckdb


def connect(folder):
    c = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return c


def canonical(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(canonical, v))
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, Counter(canonical(tuple(r)) for r in df.select(*names).collect())


def sql_rows(connection, sql):
    found = connection.execute(sql)
    names = [x[0] for x in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(canonical(tuple(r[i] for i in order)) for r in found.fetchall())
