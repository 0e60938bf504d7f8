"""Order-insensitive comparison of a Spark result with an SQL result on the same files."""

import math
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    found = con.sql(sql)
    return _rows(found.columns, found.fetchall())
