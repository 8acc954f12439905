"""A backfill rewrites what reads the restated days, and nothing else."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import files
from tidemark.functions.bands import banded
from tidemark import fixed_values as v
from tidemark.plans import restate
from tidemark.plans.marts import zone_statistics
from tidemark.plans.staging import stage_sentiment
from tidemark.sources.sinks import backfill, stored_days, write_days
from tests.helpers import rows

FIRST = dt.date(2024, 1, 1)


def day(n):
    return FIRST + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def raw(spark):
    """Sixty days with a gap, two readings on one day, and values of all zones."""
    made = [(day(n), (n * 37) % 101) for n in range(60) if n not in (20, 21, 45)]
    made += [(day(30), 77)]
    values = [(d, x, FIRST) for d, x in made]
    df = spark.createDataFrame(values, "timestamp_date date, value long, ingested_at date")
    return df.withColumns({
        "value_classification": banded(F.col("value"), v.SENTIMENT_LABELS),
        "ingested_at": F.col("ingested_at").cast("timestamp"),
    })


def written(spark, path, key):
    return {d: files.names(spark, f"{path}/{key}={d}") for d in stored_days(spark, path, key)}


@pytest.mark.parametrize(
    ("start", "end", "change"),
    [
        (33, 35, "value"), (0, 2, "value"), (57, 59, "value"), (19, 22, "filled"), (29, 31, "emptied"),
        (25, 25, "value"),
    ],
)
def test_equal_to_a_full_rebuild(spark, raw, folder, start, end, change):
    raw_path, staged_path, zones_path = (folder(n) for n in ("raw", "staged", "zones"))
    write_days(raw, raw_path, restate.DAY)
    restate.store_sentiment(stage_sentiment(raw), staged_path)
    staged = spark.read.parquet(staged_path)
    restate.store_zones(staged, zones_path)
    inside = F.col("timestamp_date").between(F.lit(day(start)), F.lit(day(end)))
    restated = raw.withColumn("value", F.when(inside, 100 - F.col("value")).otherwise(F.col("value")))
    if change == "filled":
        more = raw.limit(1).withColumn(
            "timestamp_date", F.explode(F.array(F.lit(day(20)), F.lit(day(21))))
        )
        restated = raw.unionByName(more.select(*raw.columns))
    elif change == "emptied":
        restated = raw.where(~inside)
    days, zones = written(spark, staged_path, restate.DAY), written(spark, zones_path, restate.ZONE)
    _, low, high = restate.affected_days(raw, day(start), day(end))
    before = [tuple(r) for r in staged.where(F.col(restate.DAY).between(low, high)).select(restate.ZONE).collect()]
    before = spark.createDataFrame(before, f"{restate.ZONE} string")

    backfill(restated, raw_path, restate.DAY, day(start), day(end))
    low, high = restate.restate_sentiment(
        spark.read.parquet(raw_path), staged_path, day(start), day(end)
    )
    want = stage_sentiment(restated)
    got = spark.read.parquet(staged_path).select(*want.columns)
    assert rows(got) == rows(want)

    after = written(spark, staged_path, restate.DAY)
    rewritten = {d for d in {*days, *after} if days.get(d) != after.get(d)}
    assert rewritten <= {str(day(n)) for n in range(60) if low <= day(n) <= high}
    # the interval, and at most the thirteen rows that look back on it
    reached = [n for n in range(60) if low <= day(n) <= high and n > end]
    assert len([n for n in reached if str(day(n)) in after]) <= 13
    assert low == day(start)

    touched = restate.restate_zones(spark, before, staged_path, zones_path, low, high)
    moved = written(spark, zones_path, restate.ZONE)
    assert {z for z in {*zones, *moved} if zones.get(z) != moved.get(z)} <= set(touched)
    stored = restate.zone_statistics(spark.read.parquet(zones_path))
    whole = zone_statistics(want)
    assert rows(stored.select(*whole.columns)) == rows(whole)


def test_whole_months_are_written(spark, raw, folder):
    path = folder("months")
    restate.store_sentiment(stage_sentiment(raw), path, restate.MONTH)
    months = written(spark, path, restate.MONTH)
    changed = F.col(restate.DAY).between(F.lit(day(25)), F.lit(day(26)))
    value = F.when(changed, 1).otherwise(F.col("value")).cast("long")
    restated = raw.withColumn("value", value)
    low, high = restate.restate_sentiment(restated, path, day(25), day(26), restate.MONTH)
    assert (low, high) == (day(0), dt.date(2024, 2, 29))
    want = stage_sentiment(restated)
    assert rows(spark.read.parquet(path).select(*want.columns)) == rows(want)
    only = restated.where(F.col(restate.DAY) < F.lit(day(31)))
    low, high = restate.restate_sentiment(only, path, day(31), day(59), restate.MONTH)
    want = stage_sentiment(only)
    assert rows(spark.read.parquet(path).select(*want.columns)) == rows(want)
    assert set(written(spark, path, restate.MONTH)) == {"2024-01-01"} < set(months)


def test_untouched_zones_stay(spark, raw, folder):
    staged_path, zones_path = folder("staged"), folder("zones")
    staged = stage_sentiment(raw)
    write_days(staged, staged_path, restate.DAY)
    restate.store_zones(staged, zones_path)
    zones = written(spark, zones_path, restate.ZONE)
    one = staged.where(F.col("sentiment_zone") == "neutral").agg(F.max(restate.DAY)).first()[0]
    before = spark.createDataFrame([("neutral",)], f"{restate.ZONE} string")
    assert restate.restate_zones(spark, before, staged_path, zones_path, one, one) == ["neutral"]
    moved = written(spark, zones_path, restate.ZONE)
    assert {z for z in moved if moved[z] != zones[z]} == {"neutral"}
