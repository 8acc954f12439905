"""Snapshots from stored states of ticks.

A day of ticks is reduced to one row per asset. Added to the state of the day before,
it gives the state of the new day: all-time marks, the last tick so far, and the
day's own range. A snapshot then reads the states of its day and of the days that its
horizons look back to; ticks of earlier days are never read again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exact import ExactSum
from tidemark.functions.ratios import change_pct
from tidemark.operators.ticks import tick_order
from tidemark.session import materialised
from tidemark.sources.sinks import stored_days, write_days

DAY = "day"


def day_states(
    ticks: DataFrame, key: str = "id", time: str = "ts", value: str = "value"
) -> DataFrame:
    """One row per asset and day. Of several ticks at the last time the largest counts."""
    return ticks.groupBy(key, F.col(time).cast("date").alias(DAY)).agg(
        F.struct(
            F.max(time).alias("at"), F.max_by(value, tick_order(time, value)).alias("value")
        ).alias("last"),
        F.min(time).alias("first_at"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.count("*").alias("ticks"),
        *ExactSum.of(value).columns("sum"),
    )


def advanced(before: DataFrame | None, today: DataFrame, day: Column, key: str = "id") -> DataFrame:
    """The state of ``day``: what was known before it, and the ticks in ``today``.

    ``before`` is a state or None; ``today`` has rows of :func:`day_states`, of which
    those of earlier days only add to the all-time columns. The state has one row per
    asset seen so far; the day's own columns are NULL for an asset without a tick in it.
    """
    own = ["high", "low", *(f"sum_{field}" for field in ExactSum.FIELDS)]
    in_day = F.col(DAY) == day
    parts = [
        today.select(
            key, "last", "first_at", F.col("high").alias("ath"), F.col("low").alias("atl"), "ticks",
            *[F.when(in_day, F.col(c)).alias(c) for c in own],
        )
    ]
    if before is not None:
        kinds = dict(parts[0].dtypes)
        parts.append(
            before.select(
                key, "last", "first_at", "ath", "atl", "ticks",
                *[F.lit(None).cast(kinds[c]).alias(c) for c in own],
            )
        )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy(key).agg(
        F.max("last").alias("last"),
        F.min("first_at").alias("first_at"),
        F.max("ath").alias("ath"),
        F.min("atl").alias("atl"),
        F.sum("ticks").alias("ticks"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *ExactSum.merged("sum").columns("sum"),
    ).withColumn(DAY, day)


def _state(spark: SparkSession, path: str, day: str | None) -> DataFrame | None:
    """The state of one day, read from its folder alone."""
    return None if day is None else spark.read.parquet(f"{path}/{DAY}={day}")


def _latest(days: list[str], until: str) -> str | None:
    return max((d for d in days if d <= until), default=None)


def extend(
    spark: SparkSession,
    path: str,
    ticks: DataFrame,
    since: dt.date | str | None = None,
    key: str = "id",
    time: str = "ts",
    value: str = "value",
) -> None:
    """Add the days of ``ticks`` to the states at ``path``, one folder a day.

    ``ticks`` hold whole days. Days that are stored already from the first of them on
    are made anew, so a day may be restated with all days after it. Days before
    ``since`` become one state, that of the last of them: a history needs no state
    for every day. A day without any tick has no state.
    """
    states = materialised(day_states(ticks, key, time, value))
    # one row a day
    days = [str(r[0]) for r in states.select(DAY).distinct().orderBy(DAY).collect()]
    old = [d for d in days if since is not None and d < str(since)]
    for day in [*old[-1:], *days[len(old):]]:
        known = stored_days(spark, path, DAY)
        earlier = [d for d in known if d < (old[0] if day in old else day)]
        before = _state(spark, path, max(earlier, default=None))
        in_scope = F.col(DAY) <= day if day in old else F.col(DAY) == F.lit(day).cast("date")
        state = advanced(before, states.where(in_scope), F.lit(day).cast("date"), key)
        write_days(state, path, DAY)


def snapshot_at(
    spark: SparkSession, path: str, day: dt.date | str, horizons: Mapping[str, int], key: str = "id"
) -> DataFrame:
    """The snapshot at the end of ``day``; ``horizons`` maps a suffix to days back.

    Equal to :func:`tidemark.operators.ticks.snapshot` at the last instant of the day.
    A day without a state stands where the day before it did, without a range of its own.
    """
    days = stored_days(spark, path, DAY)
    stored = _latest(days, str(day))
    if stored is None:
        raise ValueError(f"no state up to {day} at {path}")
    back = {
        h: _latest(days, str(dt.date.fromisoformat(str(day)) - dt.timedelta(days=n)))
        for h, n in horizons.items()
    }
    read = sorted({stored, *filter(None, back.values())})
    states = spark.read.option("basePath", path).parquet(*[f"{path}/{DAY}={d}" for d in read])
    at = {d: F.col(DAY) == F.lit(d).cast("date") for d in read}

    def of(column: str, d: str | None) -> Column:
        # one row per asset and day
        return F.max(F.when(F.lit(False) if d is None else at[d], F.col(column)))

    own = stored if stored == str(day) else None
    total = ExactSum(*(of(f"sum_{field}", own) for field in ExactSum.FIELDS)).total()
    grouped = states.groupBy(key).agg(
        of("last", stored)["value"].alias("current_price"),
        total.alias("total_volume"),
        of("high", own).alias("high_24h"),
        of("low", own).alias("low_24h"),
        of("ath", stored).alias("ath"),
        of("atl", stored).alias("atl"),
        of("first_at", stored).alias("first_at"),
        of("last", stored)["at"].alias("last_at"),
        of("ticks", stored).alias("ticks"),
        *[of("last", d)["value"].alias(f"_past_{h}") for h, d in back.items()],
    )
    current = F.col("current_price")
    return grouped.withColumns(
        {f"change_pct_{h}": change_pct(current, F.col(f"_past_{h}")) for h in horizons}
        | {f"change_{h}": current - F.col(f"_past_{h}") for h in horizons}
        | {
            "ath_change_pct": change_pct(current, F.col("ath")),
            "atl_change_pct": change_pct(current, F.col("atl")),
        }
    ).drop(*[f"_past_{h}" for h in horizons])
