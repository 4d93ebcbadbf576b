"""Running a query and its DuckDB twin side by side."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
import pandas as pd

from suite.base import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return value.replace(tzinfo=None).isoformat()
    return value


def sort_rows(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def spark_rows(df):
    names = sorted(df.columns)
    return names, sort_rows([tuple(plain(r[n]) for n in names) for r in df.collect()])


def duck_rows(con, sql: str):
    cursor = con.cursor()
    cursor.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], sort_rows([tuple(plain(row[i]) for i in order) for row in rows])
