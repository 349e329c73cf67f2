"""Run a query and its SQL side by side and compare them by value."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(r[i] for i in order) for r in rows), key=repr
    )


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    relation = con.sql(sql)
    return rows_of(relation.columns, relation.fetchall())
