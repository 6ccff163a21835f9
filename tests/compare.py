"""Order-insensitive comparison of a Spark result with a DuckDB one."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value + 0.0)
    return (type(value).__name__, str(value))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return normal([d[0] for d in cur.description], cur.fetchall())
