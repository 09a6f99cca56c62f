"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", repr(v)) if not math.isnan(v) else ("f", "nan")
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duckdb_table(con, sql):
    rel = con.sql(sql)
    return table(rel.columns, rel.fetchall())


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
         "BOOLEAN": "boolean"}


def duckdb_types(con, sql):
    rel = con.sql(sql)
    return {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
