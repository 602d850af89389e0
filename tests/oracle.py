"""Run a query and its DuckDB SQL on the same tables and compare rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def expected(sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    return normal([d[0] for d in found.description], found.fetchall())


def actual(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])
