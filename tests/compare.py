"""A Spark query beside its SQL in DuckDB."""

import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


def rows(columns, values):
    """The columns by name, and the rows in an order of their own."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in values)


def same(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    got, found = query(spark, sf_dir), con.execute(sql)
    assert rows(got.columns, got.collect()) == rows([c[0] for c in found.description], found.fetchall())
