"""Comparison of a query with its SQL in DuckDB."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows(columns, data):
    return sorted(repr(sorted(zip(columns, map(plain, r)))) for r in data)


def assert_same(spark, query, sql, folder):
    df = query(spark, folder)
    found = connection(folder).sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())
