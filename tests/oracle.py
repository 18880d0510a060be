"""Spark results held against DuckDB over the same tables."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(pdf):
    def cell(v):
        if v is None or pd.isna(v):
            return "-"
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(v)

    names = sorted(pdf.columns)
    return sorted(tuple(cell(v) for v in r) for r in pdf[names].itertuples(index=False)), names


def differences(spark, name, query, sql, sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for n in TABLES:
        p = f"{sf_dir}/{n}.parquet"
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    got, a = rows_of(query(spark, sf_dir).toPandas())
    want, b = rows_of(con.sql(sql).df())
    if a != b:
        return f"{name}: columns {a} and {b}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, {len(want)} wanted"
    wrong = [(x, y) for x, y in zip(got, want, strict=True) if x != y]
    return f"{name}: {len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""
