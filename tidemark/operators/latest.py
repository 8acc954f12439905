"""The most recent row of a table, as a value other queries can use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_struct(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """One row, one struct column ``latest``: NULL if the table is empty.

    Rows with the same latest date are told apart by the column values, so the
    result is the same on every run. A maximum of structs needs one
    partial-aggregate pass, no sort.
    """
    return df.agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("latest"))


def latest_row(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """The latest row; no row for an empty table."""
    picked = latest_struct(df, order, columns).filter(F.col("latest").isNotNull())
    return picked.select(*[F.col("latest")[c].alias(c) for c in columns])


def with_latest(
    df: DataFrame, source: DataFrame, order: str, columns: dict[str, str], required: bool = True
) -> DataFrame:
    """Put columns of ``source``'s latest row beside every row of ``df``.

    ``columns`` maps output to source names. ``required`` keeps no row if the
    source is empty; otherwise the columns are NULL then.
    """
    one = latest_struct(source, order, list(columns.values())).scalar()
    out = df.withColumn("_latest", one)
    if required:
        out = out.filter(F.col("_latest").isNotNull())
    return out.withColumns(
        {name: F.col("_latest")[c] for name, c in columns.items()}
    ).drop("_latest")


def latest_slice(df: DataFrame, order: str) -> DataFrame:
    """All rows of the most recent run: ``order`` equals its maximum."""
    return df.filter(F.col(order) == df.agg(F.max(order)).scalar())


def newest(df: DataFrame, column: str) -> Column:
    return df.agg(F.max(column)).scalar()
