"""Shares of a total, for rows and for groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exact import exact_total
from tidemark.functions.ratios import share_pct
from tidemark.session import materialised


def exact_sum(df: DataFrame, column: str) -> Column:
    """Sum that cannot overflow for integers and has no order of adding for doubles."""
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return F.sum(F.col(column).cast("decimal(20,0)")).cast("double")
    return exact_total(column)


def share_of_total(
    df: DataFrame, value: str, name: str, digits: int, total: Column | None = None
) -> DataFrame:
    """Each row's value in percent of the column total.

    The total is a scalar subquery, one partial-aggregate pass, instead of a
    window that would pull the table into one task. Pass it if it is known.
    """
    whole = df.agg(exact_sum(df, value)).scalar() if total is None else total
    return df.withColumn(name, F.round(share_pct(F.col(value), whole), digits))


def group_share(
    df: DataFrame,
    keys: list[str],
    value: str | None,
    name: str,
    digits: int,
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """Group sums (row counts when ``value`` is None) and their share of the total.

    The total is summed from the group rows, which are materialised so that
    the table is scanned once.
    """
    measure = F.count("*").cast("double") if value is None else exact_sum(df, value)
    grouped = materialised(
        df.groupBy(*keys).agg(
            measure.alias("_part"), *[c.alias(n) for n, c in (aggregates or {}).items()]
        )
    )
    return share_of_total(
        grouped, "_part", name, digits, grouped.agg(exact_total("_part")).scalar()
    ).drop("_part")
