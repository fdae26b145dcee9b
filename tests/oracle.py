"""Rows of a registered query and of its SQL, to be compared."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def canonical(rows, columns):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return sorted(tuple("" if x is None else repr(round(x, 6)) if isinstance(x, float) else str(x) for x in (r[p] for p in places)) for r in rows)


def compare(spark, make, sql, sf_dir):
    df = make(spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = connection(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == canonical(rel.fetchall(), list(rel.columns))
