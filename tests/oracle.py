"""Rows of a query against rows of its SQL, without regard to order."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v)


def assert_same(spark, query, sql, sf_dir=SF):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    want = con.sql(sql)
    assert columns == sorted(want.columns)
    got = sorted(plain(list(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == sorted(plain(list(r)) for r in want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
