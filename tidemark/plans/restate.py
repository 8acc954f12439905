"""Backfills that reach what depends on the restated days.

A day of the sentiment series is read by its own row, by the change of the next one
and by the trailing means of the rows after it, and it counts in its zone. Restated
days widen to those rows and zones; nothing else is computed or written again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.functions.exact import exact_mean
from tidemark.operators.shares import share_of_total
from tidemark.plans.staging import stage_sentiment
from tidemark.sources.sinks import backfill, in_range, remove_day, stored_days, write_days

DAY, MONTH = "timestamp_date", "month"
ZONE = "sentiment_zone"


def _edge(raw: DataFrame, beyond: Column, rows: int, back: bool) -> dt.date | None:
    """The day of the ``rows``-th row beyond an interval, or of the last one there is."""
    nearest = F.col(DAY).desc() if back else F.col(DAY).asc()
    days = raw.where(beyond).select(DAY).orderBy(nearest).limit(rows)
    return days.agg((F.min if back else F.max)(DAY)).first()[0]


def affected_days(
    raw: DataFrame, start: dt.date | str, end: dt.date | str, reach: int = v.LONG_MEAN - 1
) -> tuple[dt.date, dt.date, dt.date]:
    """First day to read, first and last day to write, for restated days ``start`` to ``end``.

    ``reach`` is how many rows back a frame looks: that many rows before the interval
    are read, and that many after it change.
    """
    low, high = (dt.date.fromisoformat(str(d)) for d in (start, end))
    day = F.col(DAY)
    first = _edge(raw, day < F.lit(low), reach, back=True)
    last = _edge(raw, day > F.lit(high), reach, back=False)
    return first or low, low, last or high


def _in_folders(sentiment: DataFrame, folder: str) -> DataFrame:
    """The staged series with the column it is partitioned by: its day, or its month."""
    return sentiment if folder == DAY else sentiment.withColumn(MONTH, F.trunc(DAY, "month"))


def store_sentiment(sentiment: DataFrame, path: str, folder: str = DAY) -> None:
    """Store the staged series, a folder a day, or a month where days are small."""
    write_days(_in_folders(sentiment, folder), path, folder)


def restate_sentiment(
    raw: DataFrame,
    staged_path: str,
    start: dt.date | str,
    end: dt.date | str,
    folder: str = DAY,
) -> tuple[dt.date, dt.date]:
    """Bring the stored staged series up to ``raw``, of which days ``start`` to ``end`` changed.

    Writes the rows of those days and the rows after them that look back on them, by
    whole folders, and removes folders that hold no row any more. Of ``raw`` only the
    days written are read, and the rows before them that they look back on. Returns
    the first and last day written.
    """
    _, first, last = affected_days(raw, start, end)
    if folder == MONTH:
        first, after = first.replace(day=1), last.replace(day=28) + dt.timedelta(days=4)
        last = after.replace(day=1) - dt.timedelta(days=1)
    read_from, _, _ = affected_days(raw, first, last)
    staged = _in_folders(stage_sentiment(in_range(raw, DAY, read_from, last)), folder)
    backfill(staged, staged_path, folder, first, last)
    return first, last


def zone_rows(sentiment: DataFrame) -> DataFrame:
    """What is stored of each zone: all of its statistics but the share of all days."""
    return sentiment.groupBy(ZONE).agg(
        F.count("*").alias("days_count"),
        exact_mean("value", 1).alias("avg_index_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.coalesce(F.round(F.stddev_samp("value"), 1), F.lit(0.0)).alias("std_dev"),
    )


def store_zones(sentiment: DataFrame, path: str) -> None:
    """Store the statistics of every zone, a folder a zone."""
    write_days(zone_rows(sentiment), path, ZONE)


def restate_zones(
    spark: SparkSession,
    before: DataFrame,
    staged_path: str,
    zones_path: str,
    first: dt.date | str,
    last: dt.date | str,
) -> list[str]:
    """Rewrite the zones that hold a row of the restated days, then or now.

    ``before`` has (day, zone) of those days as they were. Returns the zones, at most
    as many as there are labels.
    """
    staged = spark.read.parquet(staged_path)
    after = in_range(staged, DAY, first, last)
    moved = before.select(ZONE).unionAll(after.select(ZONE)).distinct()
    zones = sorted(r[0] for r in moved.collect())
    write_days(zone_rows(staged.where(F.col(ZONE).isin(zones))), zones_path, ZONE)
    filled = {r[0] for r in staged.select(ZONE).distinct().collect()}
    for zone in set(stored_days(spark, zones_path, ZONE)) - filled:
        # a zone that holds no day any more
        remove_day(spark, zones_path, ZONE, zone)
    return zones


def zone_statistics(zones: DataFrame) -> DataFrame:
    """The stored zones with their share of all days, from the stored counts."""
    return share_of_total(zones, "days_count", "pct_of_total_days", 1)
