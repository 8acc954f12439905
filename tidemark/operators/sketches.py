"""Distinct values counted from stored sketches.

A sketch of a few kilobytes per column and snapshot stands for its values. Sketches
of many snapshots merge into that of their union, so the distinct values of any range
of days are estimated without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 2 to this power registers: an estimate is off by 1.04 / sqrt(registers) in the mean.
PRECISION = 12
_TAKEN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def relative_error(precision: int = PRECISION) -> float:
    """One standard deviation of an estimate, as a share of the true count."""
    return 1.04 / 2 ** (precision / 2)


def distinct_states(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), precision: int = PRECISION
) -> DataFrame:
    """A sketch per column, and per value of ``by``; NULL is no value.

    Partial sketches merge on the map side, so a group with a third of all rows sends
    one sketch a task.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    taken = {
        c: F.col(c) if isinstance(kind, _TAKEN) else F.col(c).cast("string")
        for c, kind in kinds.items()
    }
    sketches = [F.hll_sketch_agg(x, F.lit(precision)).alias(c) for c, x in taken.items()]
    return df.groupBy(*by).agg(*sketches) if by else df.agg(*sketches)


def merged(states: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The sketches of the union of all rows of ``states`` (per value of ``by``)."""
    unions = [F.hll_union_agg(c).alias(c) for c in columns]
    return states.groupBy(*by).agg(*unions) if by else states.agg(*unions)


def estimates(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The estimated distinct values, in place of the sketches."""
    found: Mapping[str, Column] = {c: F.hll_sketch_estimate(c) for c in columns}
    return states.withColumns(dict(found))
