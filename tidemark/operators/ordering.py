"""Whole-table order without a whole-table task.

A window with no partition key sends every row to one task. Here the table is
range-partitioned on the ordering instead. Each range is a *slice*: a run of
consecutive rows that one task holds. What a slice needs from the slices before
it is one small row per slice, so no step sees more than a slice, or the list
of slices, at once. A table that was counted to be one slice is not stored or cut:
the same columns come from one task that holds it.

Rows that tie on the given order follow a hash of the whole row, so results do not
depend on the number of slices. Rows equal in every column are told apart by a
number stored with them before the split, so that any of them can be cut.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.lookups import join_per_key
from tidemark.session import materialised

SLICE_ROWS = 2_000_000
#: Slices of ``LEAST_ROWS`` may be as many as it takes. Of smaller ones there are at most
#: ``MOST_SMALL``: each is a task, with a result, a file and a share of a sample for the driver.
LEAST_ROWS, MOST_SMALL = 250_000, 200
#: A table that the planner thinks larger is stored before it is counted, not read twice.
COUNTED_BYTES = 256 * 2**20
#: Bytes a row that travel with the keys; wider rows stay behind and are joined by number.
CARRIED_BYTES = 64
SLICE, POS, IDX, _COPY, _TIE = "_slice", "_pos", "_idx", "_copy", "_tie"
_IN_SLICE_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row in the low 33 bits


class Slices(NamedTuple):
    """Rows with ``_slice`` and ``_pos``, and whether they are one slice."""

    rows: DataFrame
    single: bool


def _before(*order: Column | str) -> WindowSpec:
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _counted_small(df: DataFrame, size: int) -> bool:
    """Whether ``df`` was counted and fits a slice; a table thought large is not counted."""
    thought = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return thought <= COUNTED_BYTES and df.count() <= size


def _one_slice(df: DataFrame, order: Sequence[Column | str], ties: Sequence[Column]) -> Slices:
    place = Window.partitionBy(SLICE).orderBy(*order, *ties)
    rows = df.withColumn(SLICE, F.lit(0)).withColumn(
        POS, (F.row_number().over(place) - 1).cast("bigint")
    )
    return Slices(rows, True)


def _parts(rows: int, size: int) -> int:
    return min(rows // size + 1, max(MOST_SMALL, rows // LEAST_ROWS + 1))


def _cut(
    stored: DataFrame, order: Sequence[Column | str], ties: Sequence[Column], rows: int, size: int
) -> Slices:
    """Range-partition into slices of about ``size`` rows, or of more (see ``LEAST_ROWS``).
    One exchange and one stored table: the numbering depends on a sampled split, so every
    later read, a retry after a lost executor included, must see the same slices."""
    cut = (
        stored.repartitionByRange(_parts(rows, size), *order, *ties)
        .sortWithinPartitions(*order, *ties)
        .drop(_COPY)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_SLICE_BITS)))
    )
    return Slices(materialised(cut), False)


def sliced(df: DataFrame, order: Sequence[Column | str], size: int = SLICE_ROWS) -> Slices:
    """The slices of a table in ``order``.

    A table of several slices is stored first, each row with a number of its own: a
    task that is run again then sees the same numbers.
    """
    tie = F.xxhash64(*df.columns)
    if _counted_small(df, size):
        return _one_slice(df, order, [tie])
    stored = materialised(df.withColumn(_COPY, F.monotonically_increasing_id()))
    rows = stored.count()  # from the file footers
    if rows <= size:
        return _one_slice(stored.drop(_COPY), order, [tie])
    return _cut(stored, order, [tie, F.col(_COPY)], rows, size)


def sliced_keys(keys: DataFrame, order: Sequence[Column | str], size: int = SLICE_ROWS) -> Slices:
    """The slices of a stored table without two rows that are equal in ``order``."""
    rows = keys.count()
    if rows <= size:
        return _one_slice(keys, order, [])
    return _cut(keys, order, [], rows, size)


def slice_rows(
    df: DataFrame, order: Sequence[Column | str], size: int = SLICE_ROWS
) -> DataFrame:
    """Add ``_slice`` (rank of the range) and ``_pos`` (row within it, from 0)."""
    return sliced(df, order, size).rows


def _per_slice_before(
    rows: DataFrame, totals: Mapping[str, Column], over: Mapping[str, Column]
) -> DataFrame:
    """One row per slice: ``over`` evaluated on the totals of the slices before it."""
    per_slice = rows.groupBy(SLICE).agg(*[c.alias(n) for n, c in totals.items()])
    return per_slice.select(SLICE, *[c.over(_before(SLICE)).alias(n) for n, c in over.items()])


def _with_earlier(
    slices: Slices, totals: Mapping[str, Column], over: Mapping[str, Column]
) -> DataFrame:
    """Each row with what the slices before its own add up to (NULL in the first)."""
    if slices.single:
        return slices.rows.withColumns({name: F.lit(None) for name in over})
    # one row per slice
    starts = F.broadcast(_per_slice_before(slices.rows, totals, over))
    return slices.rows.join(starts, SLICE)


def with_position(
    df: DataFrame, order: Sequence[Column | str], size: int = SLICE_ROWS
) -> DataFrame:
    """Add ``_idx``, the 0-based position of each row in the whole ordering."""
    started = _with_earlier(
        sliced(df, order, size), {"_n": F.count("*")}, {"_start": F.sum("_n")}
    )
    return started.withColumn(IDX, F.coalesce("_start", F.lit(0)) + F.col(POS)).drop("_start")


def trailing(
    positioned: DataFrame,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    before: int,
    block: int = 50_000,
) -> DataFrame:
    """ROWS frames that look back at most ``before`` rows, on a positioned table.

    Rows are cut into blocks by position; the last ``before`` rows of a block
    are copied into the following one, so each block is complete on its own.
    """
    home = F.floor(F.col(IDX) / F.lit(block))
    reach = F.floor((F.col(IDX) + F.lit(before)) / F.lit(block))
    window = Window.partitionBy("_block").orderBy(IDX)
    out = positioned.withColumn("_block", F.explode(F.sequence(home, reach)))
    out = out.withColumns({name: build(window) for name, build in columns.items()})
    return out.filter(F.col("_block") == home).drop("_block")


def series_columns(
    df: DataFrame,
    order: Sequence[Column | str],
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    before: int,
    size: int = SLICE_ROWS,
) -> DataFrame:
    """Trailing frames over one unpartitioned series."""
    if _counted_small(df, size):
        whole = Window.partitionBy(SLICE).orderBy(*order, F.xxhash64(*df.columns))
        out = df.withColumn(SLICE, F.lit(0))
        return out.withColumns({n: build(whole) for n, build in columns.items()}).drop(SLICE)
    return trailing(with_position(df, order, size), columns, before).drop(SLICE, POS, IDX)


def running_total(positioned: DataFrame, value: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` over the whole ordering."""
    starts = _per_slice_before(positioned, {"_sum": F.sum(value)}, {"_base": F.sum("_sum")})
    within = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return (
        positioned.join(F.broadcast(starts), SLICE)
        .withColumn(name, F.coalesce("_base", F.lit(0)) + F.sum(value).over(within))
        .drop("_base")
    )


def earlier_max(
    df: DataFrame, order: str, value: Column, name: str, size: int = SLICE_ROWS
) -> DataFrame:
    """Per distinct ``order`` value, the maximum of ``value`` over all smaller ones.

    Returns one row per ``order`` with its own ``low`` and ``high`` as well. NULL is
    no place in an order: rows without one are left out.
    """
    per_key = (
        df.filter(F.col(order).isNotNull())
        .groupBy(order)
        .agg(F.min(value).alias("low"), F.max(value).alias("high"))
    )
    slices = sliced_keys(materialised(per_key), [F.col(order)], size)
    within = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    return _with_earlier(slices, {"_top": F.max("high")}, {"_base": F.max("_top")}).select(
        order, "low", "high", F.greatest("_base", F.max("high").over(within)).alias(name)
    )


def _value_order(value: str, descending: bool) -> Column:
    return F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()


def ranks_by_value(
    counts: DataFrame,
    value: str,
    ties: str,
    name: str,
    descending: bool = True,
    size: int = SLICE_ROWS,
) -> DataFrame:
    """Rank of each distinct value: 1 + rows with a value strictly ahead.

    ``counts`` has one row per value; ``ties`` is how many rows share it.
    """
    keys = materialised(counts.select(value, ties))
    slices = sliced_keys(keys, [_value_order(value, descending)], size)
    within = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce("_base", F.lit(0)) + F.coalesce(F.sum(ties).over(within), F.lit(0))
    return _with_earlier(slices, {"_n": F.sum(ties)}, {"_base": F.sum("_n")}).select(
        value, ties, (F.lit(1) + ahead).cast("bigint").alias(name)
    )


def attach_rank(
    df: DataFrame,
    counts: DataFrame,
    value: str,
    ties: str,
    name: str,
    descending: bool = True,
    size: int = SLICE_ROWS,
) -> DataFrame:
    """``rank()`` by ``value``, from the number of rows per value."""
    ranks = materialised(ranks_by_value(counts, value, ties, name, descending, size))
    return join_per_key(df, ranks, value, ties)


def competition_rank(
    df: DataFrame, value: str, name: str, descending: bool = True, size: int = SLICE_ROWS
) -> DataFrame:
    """``rank()`` over the whole table: ties share a rank.

    Rows are counted per value first, so a value a third of the table shares is
    one row when ordered; the rank then goes back to the rows by value.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("_ties"))
    return attach_rank(df, counts, value, "_ties", name, descending, size)


def _row_bytes(df: DataFrame, columns: Sequence[str]) -> int:
    """What the planner takes a row of these columns for."""
    schema = df._jdf.schema()
    return sum(schema.apply(c).dataType().defaultSize() for c in columns)


def occurrence_in_group(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    name: str,
    size: int = SLICE_ROWS,
) -> DataFrame:
    """``row_number()`` per group for groups of any size.

    Slices are cut on (group, order), so a group larger than a slice continues
    in the next ones. Only the first and last group of a slice can be shared
    with a neighbour: at most two rows per slice carry the counts across. Only the
    keys of wide rows are ordered; the numbers then go back to the stored rows.
    """
    if _counted_small(df, size):
        place = Window.partitionBy(group).orderBy(*order, F.xxhash64(*df.columns))
        return df.withColumn(name, F.row_number().over(place).cast("bigint"))
    keys = list(dict.fromkeys([group, *order]))
    stored = materialised(
        df.withColumns({_COPY: F.monotonically_increasing_id(), _TIE: F.xxhash64(*df.columns)})
    )
    wide = _row_bytes(df, [c for c in df.columns if c not in keys]) > CARRIED_BYTES
    narrow = stored.select(*keys, F.col(_COPY).alias("_row"), _TIE, _COPY) if wide else stored
    ties = [F.col(_TIE), F.col(_COPY)]
    rows = _cut(narrow, [F.col(c) for c in (group, *order)], ties, stored.count(), size).rows
    ends = rows.groupBy(SLICE).agg(F.max(POS).alias("_end"))
    edge = (
        rows.join(F.broadcast(ends), SLICE)
        .filter((F.col(POS) == 0) | (F.col(POS) == F.col("_end")))
        .select(F.col(SLICE).alias("_s"), F.col(group).alias("_g"))
        .distinct()
    )
    in_group = (F.col(SLICE) == F.col("_s")) & F.col(group).eqNullSafe(F.col("_g"))
    shared = (
        rows.join(F.broadcast(edge), in_group, "left_semi")
        .groupBy(SLICE, group)
        .agg(F.count("*").alias("_n"))
    )
    carried = Window.partitionBy(group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = shared.select(
        F.col(SLICE).alias("_s"), F.col(group).alias("_g"), F.sum("_n").over(carried).alias("_base")
    )
    within = Window.partitionBy(SLICE, group).orderBy(POS)
    numbered = rows.join(F.broadcast(starts), in_group, "left").withColumn(
        name, (F.coalesce("_base", F.lit(0)) + F.row_number().over(within)).cast("bigint")
    )
    if wide:
        numbered = stored.join(numbered.select(F.col("_row").alias(_COPY), name), _COPY)
    return numbered.select(*df.columns, name)


def group_runs(
    df: DataFrame,
    order: Sequence[str],
    group: str,
    first: str,
    last: str,
    length: str,
    size: int = SLICE_ROWS,
) -> DataFrame:
    """Maximal runs of consecutive rows with the same ``group`` value.

    Equal rows are counted into one before anything is ordered. The last value of
    each slice stands in for the row before the next one, so a single window over the
    slice finds the starts and their running number. Runs are reduced inside the
    slice; only the first of a slice continues an earlier one, and a run number
    counts all starts up to it.
    """
    keys = list(dict.fromkeys([*order, group]))
    narrow, places = df.select(*keys), [F.col(c) for c in order]
    counted = narrow.groupBy(*keys).agg(F.count("*").alias("_rows"))
    tie = F.xxhash64(*keys)
    if _counted_small(narrow, size):
        slices = _one_slice(counted, places, [tie])
    else:
        slices = _cut(counted, places, [tie, F.col(group)], narrow.count(), size)
    value = F.struct(group)
    within = Window.partitionBy(SLICE).orderBy(POS)
    previous, edged = F.lag(value).over(within), slices.rows
    if not slices.single:
        # one row per slice; no slice between two filled ones is missing from the order
        ends = edged.groupBy(SLICE).agg(F.max_by(value, POS).alias("_last"))
        edges = ends.select(SLICE, F.lag("_last").over(Window.orderBy(SLICE)).alias("_edge"))
        edged = edged.join(F.broadcast(edges), SLICE)
        previous = F.coalesce(previous, F.col("_edge"))
    starts = F.when(
        F.col("_prev").isNull() | ~F.col("_prev")[group].eqNullSafe(F.col(group)), 1
    ).otherwise(0)
    in_slice = (
        edged.withColumn("_prev", previous)
        .withColumn("_start", starts)
        .withColumn("_run", F.sum("_start").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        # a run has one group value; as a key it costs nothing, as a text minimum a sort
        .groupBy(SLICE, "_run", group)
        .agg(
            F.min(order[0]).alias(first),
            F.max(order[0]).alias(last),
            F.sum("_rows").alias(length),
        )
    )
    if slices.single:
        return in_slice.select(group, first, last, length)
    pieces = materialised(in_slice)
    bases = _per_slice_before(pieces, {"_n": F.max("_run")}, {"_base": F.sum("_n")})
    return (
        pieces.join(F.broadcast(bases), SLICE)
        .withColumn("_run", F.coalesce("_base", F.lit(0)) + F.col("_run"))
        .groupBy("_run", group)
        .agg(
            F.min(first).alias(first), F.max(last).alias(last), F.sum(length).alias(length)
        )
        .drop("_run")
    )
