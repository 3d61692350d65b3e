"""Run queries and their SQL on one scale factor and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return (0, str(value))
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return (1, "nan") if math.isnan(number) else (1, f"{number:.5f}".replace("-0.00000", "0.00000"))
    if isinstance(value, datetime.datetime):
        return (2, value.replace(tzinfo=None).isoformat())
    return (3, str(value))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return normal([c[0] for c in result.description], result.fetchall())
