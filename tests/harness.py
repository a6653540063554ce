"""Compares a registered query with its SQL twin."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "null" if v is None else f"{type(v).__name__}:{v}"


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(v) for v in r) for r in df.select([f"`{c}`" for c in cols]).collect())


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
