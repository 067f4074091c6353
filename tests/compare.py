"""Spark result against DuckDB result, value for value."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def rows_of_frame(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    found = con.execute(sql)
    names = [column[0] for column in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in found.fetchall())
    return [names[i] for i in order], rows


def difference(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    spark_names, spark_rows = rows_of_frame(df)
    sql_names, sql_rows = rows_of_sql(con, sql)
    if spark_names != sql_names:
        return f"columns {spark_names} against {sql_names}"
    extra, missing = spark_rows - sql_rows, sql_rows - spark_rows
    if not extra and not missing:
        return ""
    return (
        f"{sum(spark_rows.values())} rows against {sum(sql_rows.values())}, "
        f"{sum(extra.values())} differ, such as {sorted(extra, key=repr)[:2]} "
        f"against {sorted(missing, key=repr)[:2]}"
    )


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value
