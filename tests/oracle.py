"""Runs registered queries and their SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v) if v % 1 else int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else int(v) if v == int(v) else round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


def sql_rows(folder: str, sql: str):
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    got = c.sql(sql)
    return sorted(got.columns), rows(got.columns, got.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, df.collect())
