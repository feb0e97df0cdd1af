"""Run a query on Spark and its SQL on DuckDB and compare names, types and values."""

import datetime as dt
import glob
import math
import os

import duckdb

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def compare(df, con, sql):
    """None if equal, else what differs."""
    rel = con.sql(sql)
    want_types = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    got_types = dict(df.dtypes)
    if got_types != want_types:
        diff = {c: (got_types.get(c), want_types.get(c)) for c in got_types.keys() | want_types.keys()
                if got_types.get(c) != want_types.get(c)}
        return f"schema (spark, sql): {diff}"
    names = sorted(got_types)
    at = [rel.columns.index(n) for n in names]
    want = sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=str)
    got = sorted((tuple(norm(r[n]) for n in names) for r in df.collect()), key=str)
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, columns {names}, first (spark, sql): {bad[:2]}" if bad else None
