"""Compare a Spark result with its SQL twin, row by row and exactly."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLE_NAMES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _kind(value: object) -> str:
    return type(value).__name__


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    expected_rows = cursor.fetchall()
    got_rows = [tuple(r) for r in spark_df.collect()]
    got, expected = rows_of(spark_df.columns, got_rows), rows_of(names, expected_rows)
    if got != expected:
        only_got = list((got - expected).items())[:3]
        only_expected = list((expected - got).items())[:3]
        return (
            f"{sum(got.values())} against {sum(expected.values())} rows\n"
            f"  spark  {only_got}\n  duckdb {only_expected}"
        )
    for name in names:
        kinds = {
            frozenset(_kind(r[cols.index(name)]) for r in rows if r[cols.index(name)] is not None)
            for cols, rows in ((spark_df.columns, got_rows), (names, expected_rows))
        }
        if len(kinds) > 1:
            return f"column {name}: {sorted(map(sorted, kinds))}"
    return None
