"""Pairs of rows that stand in the wrong order, counted without pairing them.

An inversion is a row with a smaller key and a larger value than another. Each
distinct (key, value) gets a place in the order of keys and one in the order of
values, which cut the plane into slices both ways. Two rows in one slice of either
order meet in one task, which counts by splitting at the binary digits of the value
order; rows apart in both are counted from a table of rows per cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import POS, SLICE, sliced_keys
from tidemark.session import materialised

#: Distinct rows in a slice. The cells number (distinct rows / this) squared.
SLICE_ROWS = 1_000_000
_COUNT = "decimal(38,0)"


def inverted_weight(ranks: np.ndarray, weights: np.ndarray) -> int:
    """Sum of ``weights[i] * weights[j]`` over i < j with ``ranks[i] > ranks[j]``.

    ``ranks`` are distinct. They are sorted from the leading binary digit down: two
    of them part at the first digit in which they differ, and there the pair counts
    if the one with the 1 came first.
    """
    ranks = np.argsort(np.argsort(ranks, kind="stable"), kind="stable")
    exact = np.int64 if float(weights.sum(dtype=np.float64)) < 2**31 else object
    total = 0
    for digit in reversed(range(max(0, len(ranks) - 1).bit_length())):
        one = (ranks >> digit) & 1
        group = ranks >> (digit + 1)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(np.append(starts, len(ranks)))
        heavier = np.cumsum(weights * one)
        before = np.append(0, heavier)[starts]
        zero = one == 0
        counted = (heavier - np.repeat(before, sizes))[zero]
        total += int(np.dot(weights[zero].astype(exact), counted.astype(exact)))
        # zeros first inside each group, both in the order they came
        zeros = np.cumsum(zero) - zero
        zeros_before = np.append(np.cumsum(zero) - zero, zero.sum())[starts]
        zeros_inside = np.add.reduceat(zero.astype(np.int64), starts)
        first = np.repeat(starts, sizes)
        rank_of_zero = zeros - np.repeat(zeros_before, sizes)
        rank_of_one = np.arange(len(ranks)) - first - rank_of_zero
        place = first + np.where(zero, rank_of_zero, np.repeat(zeros_inside, sizes) + rank_of_one)
        ranks[place], moved = ranks.copy(), np.empty_like(weights)
        moved[place] = weights
        weights = moved
    return total


def _counted(cells: DataFrame, slice_: str, order: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """Inversions among the rows of each slice, rows in ``order`` against ``rank``."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*order, *rank], kind="stable")
        place = np.lexsort([rows[c].to_numpy() for c in reversed(rank)])
        ranks = np.empty(len(rows), dtype=np.int64)
        ranks[place] = np.arange(len(rows))
        found = inverted_weight(ranks, rows["_n"].to_numpy(dtype=np.int64))
        return pd.DataFrame({"pairs": [Decimal(found)]})

    columns = dict.fromkeys([slice_, *order, *rank, "_n"])
    return cells.select(*columns).groupBy(slice_).applyInPandas(count, f"pairs {_COUNT}")


def _apart(cells: DataFrame) -> DataFrame:
    """Pairs that lie in different slices of both orders: rows of a cell times the rows
    of all cells earlier in the keys and later in the values, by running sums both ways."""
    rows = cells.groupBy("_k", "_v").agg(F.sum("_n").cast(_COUNT).alias("_n"))
    rows = materialised(rows)
    last = rows.agg(F.max("_v")).scalar()
    grid = rows.select("_k").distinct().select("_k", F.explode(F.sequence(F.lit(0), last)).alias("_v"))
    filled = grid.join(rows, ["_k", "_v"], "left").fillna(0, ["_n"])
    ahead = Window.unboundedPreceding, -1
    larger = F.sum("_n").over(Window.partitionBy("_k").orderBy(F.desc("_v")).rowsBetween(*ahead))
    earlier = F.sum("_larger").over(Window.partitionBy("_v").orderBy("_k").rowsBetween(*ahead))
    return (
        filled.withColumn("_larger", larger.cast(_COUNT))
        .withColumn("_pairs", earlier.cast(_COUNT))
        .where("_n > 0")
        .select((F.col("_n") * F.coalesce("_pairs", F.lit(0))).cast(_COUNT).alias("pairs"))
    )


def inversion_count(
    df: DataFrame, order: str, value: str, size: int = SLICE_ROWS
) -> DataFrame:
    """One row: the pairs (a, b) with a smaller ``order`` and a larger ``value`` in a.

    NULL is no place in an order: rows without key or value take no part, and an
    empty table has 0. Equal rows are counted into one first, so a repeated row costs
    nothing; rows with equal keys, or equal values, are ordered so that they make no
    inversion, and a hot key or value is cut like any other.
    """
    groups = df.groupBy(order, value).agg(F.count("*").alias("_n"))
    return inversions_of_groups(groups, order, value, size)


def inversions_of_groups(
    groups: DataFrame, order: str, value: str, size: int = SLICE_ROWS
) -> DataFrame:
    """:func:`inversion_count` from distinct (order, value) and their number of rows ``_n``."""
    present = groups.where(F.col(order).isNotNull() & F.col(value).isNotNull())
    pairs = materialised(present.select(order, value, "_n"))
    by_key = sliced_keys(pairs, [order, value], size)
    keyed = by_key.rows.withColumnsRenamed({SLICE: "_k", POS: "_i"})
    if by_key.single:
        place = Window.orderBy(value, order)
        ranked = keyed.withColumn("_j", F.row_number().over(place))
        parts = [_counted(ranked, "_k", ["_i"], ["_j"])]
    else:
        by_value = sliced_keys(keyed, [value, order], size)
        cells = by_value.rows.withColumnsRenamed({SLICE: "_v", POS: "_j"})
        parts = [
            _counted(cells, "_k", ["_i"], ["_v", "_j"]),
            _counted(cells, "_v", ["_k"], ["_j"]),
            _apart(cells),
        ]
    every = reduce(DataFrame.unionAll, parts)
    return every.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast(_COUNT).alias("inversions"))
