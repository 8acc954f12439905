"""Scores built from several columns of one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.bands import Bands, banded


def scorecard(ladders: Mapping[str, Bands], digits: int = 1) -> Column:
    """Sum of the points each column earns on its own ladder."""
    points = [banded(F.col(c), ladder) for c, ladder in ladders.items()]
    return F.round(reduce(add, points).cast("double"), digits)


def weighted_score(weights: Sequence[tuple[str, float, float]]) -> Column:
    """Sum of ``column / divisor * weight``, unrounded."""
    terms = [F.col(c) / F.lit(d) * F.lit(w) for c, d, w in weights]
    return reduce(add, terms)


def contrarian_signal(
    score: Column,
    sentiment: Column,
    rules: Sequence[tuple[float, float | None, str]],
    otherwise: str,
) -> Column:
    """First rule whose least score, and sentiment ceiling if it has one, holds."""
    out = F
    for least, ceiling, signal in rules:
        holds = score >= least
        if ceiling is not None:
            holds = holds & (sentiment < ceiling)
        out = out.when(holds, F.lit(signal))
    return out.otherwise(F.lit(otherwise))


def crossover(fast: Column, slow: Column) -> Column:
    """Where the fast mean stands against the slow one; NULL on either side is flat."""
    return (
        F.when(fast > slow, F.lit("improving"))
        .when(fast < slow, F.lit("deteriorating"))
        .otherwise(F.lit("flat"))
    )
