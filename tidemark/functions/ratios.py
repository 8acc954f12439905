"""Guarded arithmetic: ANSI mode raises on x/0, so every divisor is checked."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default_nulls(df: DataFrame, columns: Iterable[str], default: float = 0.0) -> DataFrame:
    """NULL as the default, in the column's own type."""
    kinds = {c: df.schema[c].dataType for c in columns}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(default).cast(kind)) for c, kind in kinds.items()}
    )


def safe_ratio(
    num: Column,
    den: Column,
    digits: int,
    scale: float = 1.0,
    otherwise: float | None = 0.0,
    guard: Column | None = None,
) -> Column:
    """``num / den * scale`` rounded where ``den > 0`` (and ``guard``), else the default."""
    holds = den > 0
    if guard is not None:
        holds = holds & guard
    ratio = F.round(num.cast("double") / den * F.lit(scale), digits)
    return F.when(holds, ratio).otherwise(F.lit(otherwise).cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL when the whole is 0 or NULL."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))


def change_pct(new: Column, old: Column) -> Column:
    return (new - old) / F.nullif(old, F.lit(0.0)) * F.lit(100.0)


def remainder_pct(*shares: Column, digits: int = 2) -> Column:
    """What the shares leave of 100, taken from the unrounded inputs."""
    rest = F.lit(100.0)
    for share in shares:
        rest = rest - share
    return F.round(rest, digits)
