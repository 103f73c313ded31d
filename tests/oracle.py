"""Spark results against DuckDB on the same tables: rows, columns, values."""

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        p = sorted(glob.glob(f"{p}/*.parquet")) if os.path.isdir(p) else [p]
        c.execute(f"create view {t} as select * from read_parquet({p})")
    return c


def _value(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, float):
        return round(x, 9)
    return tuple(map(_value, x)) if isinstance(x, (list, tuple)) else x


def compare(df, sql: str, con) -> None:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(_value(r[names.index(n)]) for n in order) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(_value(r[n]) for n in order) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w
