"""Spark against DuckDB, and rows as sorted tuples."""

import duckdb

SMALL = "/root/testdata/sf0.001"


def plain(v):
    return "%.6g" % v if isinstance(v, float) else str(list(v)) if isinstance(v, list) else str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())


def oracle(sql, d=SMALL, **tables):
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    for name, frame in tables.items():
        con.execute(f"DROP VIEW IF EXISTS {name}")
        con.register(name, frame)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(names), sorted(tuple(plain(v) for _, v in sorted(zip(names, r), key=lambda p: p[0])) for r in cur.fetchall())
