"""Data-quality checks on one table in as few passes as possible.

All checks that look at rows one by one share a single aggregation. Checks on the
groups of one key set share one grouping, and stand beside it as a scalar subquery;
so do checks that need a frame of their own. The result has one row per check:
(table_name, check_name, kind, observed, passed).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_slice
from tidemark.functions.exact import exact_total
from tidemark.operators.inversions import inversion_count, inversions_of_groups
from tidemark.operators.ordering import earlier_max


@dataclass(frozen=True)
class Check:
    """``rows`` aggregates in the shared pass; ``table`` makes its own one-row frame.

    ``groups`` aggregates the groups of ``keys``, which have their size ``_n`` and
    the aggregates ``per_group``; of two parts of a table, ``merge`` combines those.
    ``summed`` is the column whose exact sum ``rows`` rounds, else ``rows`` is a count.
    A check with its own frame says with ``of_groups`` how it follows from the groups
    of ``keys``, for tables that are kept as states.

    ``holds`` is a SQL condition on ``{observed}``: a few hundred checks are
    cheaper to plan as text than as columns built one call at a time.
    """

    name: str
    kind: str
    holds: str
    rows: Column | None = None
    table: Callable[[DataFrame], DataFrame] | None = None
    keys: tuple[str, ...] = ()
    per_group: Mapping[str, Column] = field(default_factory=dict)
    merge: Callable[[str], Column] = F.max
    groups: Column | None = None
    summed: str | None = None
    of_groups: Callable[[DataFrame], DataFrame] | None = None


def _is(op: str, bound: float) -> str:
    return f"{{observed}} {op} {bound}"


# --- one shared pass ---------------------------------------------------------
def violation(name: str, broken: Column, kind: str = "violation") -> Check:
    """No row may match; an empty table passes."""
    return Check(name, kind, _is("=", 0), rows=F.count_if(broken))


def count(name: str, op: str, bound: int, matching: Column | None = None) -> Check:
    rows = F.count("*") if matching is None else F.count_if(matching)
    return Check(name, "count", _is(op, bound), rows=rows)


def total(name: str, column: str, target: float, within: float) -> Check:
    """Column sum close to a target; without any row there is no sum and no pass."""
    near = f"round(abs({{observed}} - {target}D), 6) < {within}D"
    return Check(name, "sum", near, rows=F.round(exact_total(column), 6), summed=column)


# --- one grouping per key set -------------------------------------------------
def distinct(name: str, column: str, op: str, bound: int) -> Check:
    return Check(name, "distinct", _is(op, bound), keys=(column,), groups=F.count(column))


def unique(name: str, column: str, nulls_count: bool = True) -> Check:
    """No value twice. With ``nulls_count`` a NULL is a violation as well."""
    judged = F.lit(True) if nulls_count else F.col(column).isNotNull()
    return Check(
        name, "unique", _is("=", 0), keys=(column,), groups=_surplus_of(F.when(judged, F.col("_n")), column)
    )


def _surplus_of(rows: Column, column: str) -> Column:
    """Rows beyond the first of each key value."""
    return F.coalesce(F.sum(rows), F.lit(0)) - F.count(column)


def groups(
    name: str,
    keys: Iterable[str],
    op: str,
    bound: int,
    having: Column | None = None,
    aggregates: Mapping[str, Column] | None = None,
) -> Check:
    """Number of groups (that satisfy ``having``); ``_n`` is the group size.

    ``aggregates`` are maxima, of which a table kept in parts takes the maximum.
    """
    matching = F.count("*") if having is None else F.count_if(having)
    return Check(
        name, "group", _is(op, bound), keys=tuple(keys), per_group=aggregates or {}, groups=matching
    )


def latest_count(name: str, order: str, op: str, bound: int) -> Check:
    """Rows of the most recent run."""
    newest = F.coalesce(F.max_by("_n", order), F.lit(0))
    return Check(name, "latest", _is(op, bound), keys=(order,), groups=newest)


# --- own frame ---------------------------------------------------------------
def _surplus(df: DataFrame, column: str) -> DataFrame:
    sizes = df.groupBy(column).agg(F.count("*").alias("_n"))
    return sizes.agg(_surplus_of(F.col("_n"), column).alias("observed"))


def latest_unique(name: str, order: str, column: str) -> Check:
    """No value twice in the most recent run."""


    def of_groups(groups: DataFrame) -> DataFrame:
        runs = groups.where(F.col(order).isNotNull()).groupBy(order)
        per_run = runs.agg(_surplus_of(F.col("_n"), column).alias("_surplus"))
        newest = F.coalesce(F.max_by("_surplus", order), F.lit(0))
        return per_run.agg(newest.alias("observed"))

    return Check(
        name,
        "latest",
        _is("=", 0),
        table=lambda df: _surplus(latest_slice(df, order), column),
        keys=(order, column),
        of_groups=of_groups,
    )


def inversions(df: DataFrame, order: str, value: str) -> DataFrame:
    """Keys holding a row whose ``value`` is below that of some smaller key.

    Compared with the running maximum of the smaller keys, in one ordered pass;
    :func:`inversion_count` tells how many pairs there are.
    """
    seen = earlier_max(df, order, F.col(value), "earlier")
    return seen.filter(F.col("low") < F.col("earlier")).select(order)


def ordered(name: str, order: str, value: str) -> Check:
    """No pair of rows in which the later one has the smaller value."""
    return Check(
        name,
        "order",
        _is("=", 0),
        table=lambda df: inversion_count(df, order, value),
        keys=(order, value),
        of_groups=lambda groups: inversions_of_groups(groups, order, value),
    )


# --- column contracts --------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    """Column rules of a table. Every column not in ``optional`` must be filled.

    The range and value rules do not judge NULL.
    """

    optional: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, Iterable[str]] = field(default_factory=dict)
    least: Mapping[str, float] = field(default_factory=dict)
    most: Mapping[str, float] = field(default_factory=dict)

    def checks(self, columns: Iterable[str]) -> list[Check]:
        def rule(kind: str, column: str, broken: str) -> Check:
            rows = F.expr(f"count_if({broken.format(f'`{column}`')})")
            return Check(f"{column} {kind}", kind, _is("=", 0), rows=rows)

        out = [rule("not_null", c, "{} IS NULL") for c in columns if c not in self.optional]
        out += [rule("positive", c, "{} <= 0") for c in self.positive]
        out += [rule("min", c, f"{{}} < {bound}") for c, bound in self.least.items()]
        out += [rule("max", c, f"{{}} > {bound}") for c, bound in self.most.items()]
        out += [
            violation(f"{c} accepted_values", ~F.col(c).isin(list(values)), "accepted_values")
            for c, values in self.accepted.items()
        ]
        out += [unique(f"{c} unique", c, nulls_count=False) for c in self.unique]
        return out


# --- running -----------------------------------------------------------------
def verdict(table_name: str, check: Check, observed: str) -> str:
    """The row of a check as SQL text, from a column or expression that holds what it observed."""
    measured = f"double({observed})"
    text = check.name.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"named_struct('table_name', '{table_name}', 'check_name', '{text}', "
        f"'kind', '{check.kind}', 'observed', {measured}, "
        f"'passed', coalesce({check.holds.format(observed=measured)}, false))"
    )


def dq_suite(table_name: str, df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Run all checks on one table: one row per check."""
    numbered = {f"_c{i}": check for i, check in enumerate(checks)}
    shared = [c.rows.alias(n) for n, c in numbered.items() if c.rows is not None]
    one_row = df.agg(*shared) if shared else df.sparkSession.range(1)
    alone = {n: c.table(df).scalar() for n, c in numbered.items() if c.table is not None}
    key_sets: dict[tuple[str, ...], dict[str, Check]] = {}
    for n, check in numbered.items():
        if check.groups is not None:
            key_sets.setdefault(check.keys, {})[n] = check
    for keys, sharing in key_sets.items():
        per_group = {k: c for check in sharing.values() for k, c in check.per_group.items()}
        sizes = df.groupBy(*keys).agg(
            F.count("*").alias("_n"), *[c.alias(k) for k, c in per_group.items()]
        )
        seen = sizes.agg(F.struct(*[c.groups.alias(n) for n, c in sharing.items()])).scalar()
        alone |= {n: seen[n] for n in sharing}
    verdicts = [verdict(table_name, c, n) for n, c in numbered.items()]
    return one_row.withColumns(alone).selectExpr(f"inline(array({', '.join(verdicts)}))")


class QualityError(RuntimeError):
    """A blocking check failed."""


def require(results: DataFrame) -> None:
    """Raise if any check failed (the result is one row per check)."""
    failed = results.filter(~F.col("passed")).select("table_name", "check_name").collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name}: {r.check_name}" for r in failed))
