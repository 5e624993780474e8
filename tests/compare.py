"""Compare a Spark result with reference SQL, order-insensitively, by column name."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def reference(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, datetime.datetime):
        return (2, value.isoformat())
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [_key(v) for v in r]),
    )


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())
