"""Rows of a query and of its DuckDB statement in one form, so that they can be compared."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((plain(k), plain(v)) for k, v in x.items()))
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def counted(rows, names) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def of_spark(df) -> tuple[list, Counter]:
    return sorted(df.columns), counted([tuple(r) for r in df.collect()], df.columns)


def of_duckdb(sql: str, folder: str) -> tuple[list, Counter]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), counted(found.fetchall(), names)
