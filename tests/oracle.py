"""Compares a query with its SQL on the same tables."""

import os

import duckdb

SF = "/root/testdata/sf0.001"


def duck(sql: str, sf_dir: str = SF):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return con.execute(sql).fetchdf()


def assert_same(df, sql: str, sf_dir: str = SF):
    a, b = df.toPandas(), duck(sql, sf_dir)
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True).fillna("-") for x in (a, b))
    assert len(a) == len(b)
    for c in columns:
        assert list(a[c]) == list(b[c]), c
