"""Comparison of a query's rows with its DuckDB oracle's."""

import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def connection(sf_dir=SF_DIR):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if value != value else int(value) if value == int(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([_plain(r[k]) for k in order]) for r in rows)


def assert_same(spark, con, run, sql, sf_dir=SF_DIR):
    df, found = run(spark, sf_dir), con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, found.fetchall())
