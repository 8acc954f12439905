"""Quality verdicts from stored states, so that an append reads its own rows only.

The state of a day is what its rows add to every check: counts and exact sums in one
row, and for each key set that a check groups by, the groups with their sizes. States
of days merge into that of the whole table: counts add up, groups of equal keys
become one. A condition on the time of the run is judged when its day is added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exact import ExactSum
from tidemark.operators.quality import Check, verdict

DAY = "state_day"


def _column(check: Check) -> str:
    """A column name that stays with the check when the list of checks changes."""
    return "c_" + hashlib.md5(check.name.encode()).hexdigest()[:12]


def _key_sets(checks: Sequence[Check]) -> dict[tuple[str, ...], list[Check]]:
    sets: dict[tuple[str, ...], list[Check]] = {}
    for check in checks:
        if check.keys:
            sets.setdefault(check.keys, []).append(check)
    return sets


def _folder(path: str, keys: tuple[str, ...] = ()) -> str:
    return f"{path}/groups-{'-'.join(keys)}" if keys else f"{path}/rows"


def row_state(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row: the number of rows, and the count or exact sum of each row-level check."""
    columns: list[Column] = [F.count("*").alias("n_rows")]
    for check in checks:
        if check.summed is not None:
            columns += ExactSum.of(check.summed).columns(_column(check))
        elif check.rows is not None:
            columns.append(check.rows.alias(_column(check)))
    return df.agg(*columns)


def group_state(df: DataFrame, keys: tuple[str, ...], checks: Sequence[Check]) -> DataFrame:
    """The groups of one key set with their size and what the checks measure of each."""
    per_group = {n: c for check in checks for n, c in check.per_group.items()}
    return df.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[c.alias(n) for n, c in per_group.items()]
    )


def add_day(df: DataFrame, checks: Iterable[Check], path: str, day: str) -> None:
    """Store the state of ``day``, whose rows are ``df``.

    A day that is added again is replaced, one folder after another: a run that stops in
    between is repeated.
    """
    checks = list(checks)
    states = {_folder(path): row_state(df, checks)} | {
        _folder(path, keys): group_state(df, keys, sharing)
        for keys, sharing in _key_sets(checks).items()
    }
    for folder, state in states.items():
        state.write.mode("overwrite").parquet(f"{folder}/{DAY}={day}")


def merged_rows(states: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row: each row-level check on all days together, in a column of its own."""
    out: list[Column] = []
    for check in checks:
        name = _column(check)
        if check.summed is not None:
            out.append(F.round(ExactSum.merged(name).total(), 6).alias(name))
        elif check.rows is not None:
            out.append(F.coalesce(F.sum(name), F.lit(0)).alias(name))
    return states.agg(F.sum("n_rows").alias("n_rows"), *out)


def merged_groups(states: DataFrame, keys: tuple[str, ...], checks: Sequence[Check]) -> DataFrame:
    """The groups of one key set on all days together."""
    merged = {n: check.merge(n) for check in checks for n in check.per_group}
    return states.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), *[c.alias(n) for n, c in merged.items()]
    )


def dq_from_states(
    spark: SparkSession, table_name: str, path: str, checks: Iterable[Check]
) -> DataFrame:
    """The verdicts of ``dq_suite`` on all days whose states are at ``path``.

    No row of the table is read. A check that was not in the list when a day was added
    is not known of that day and fails the read.
    """
    checks = list(checks)
    row = merged_rows(spark.read.parquet(_folder(path)), checks)
    alone: dict[str, Column] = {}
    for keys, sharing in _key_sets(checks).items():
        groups = merged_groups(spark.read.parquet(_folder(path, keys)), keys, sharing)
        measured = [c.groups.alias(_column(c)) for c in sharing if c.groups is not None]
        if measured:
            seen = groups.agg(F.struct(*measured)).scalar()
            alone |= {_column(c): seen[_column(c)] for c in sharing if c.groups is not None}
        alone |= {
            _column(c): c.of_groups(groups).scalar() for c in sharing if c.of_groups is not None
        }
    verdicts = [verdict(table_name, c, _column(c)) for c in checks]
    return row.withColumns(alone).selectExpr(f"inline(array({', '.join(verdicts)}))")


def suites_from_states(
    spark: SparkSession, root: str, checks: dict[str, list[Check]]
) -> DataFrame:
    """The verdicts on several tables, whose states lie in a folder each under ``root``."""
    parts = [dq_from_states(spark, name, f"{root}/{name}", own) for name, own in checks.items()]
    return reduce(DataFrame.unionByName, parts)
