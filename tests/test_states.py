"""Results from stored states against the same from all rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators import quality as q
from tidemark.operators import quality_states as qs
from tidemark.operators import sketches, tick_states, ticks
from tidemark.catalog import ALL_TABLES
from tidemark.plans import checks
from tidemark.session import materialised
from tidemark.sources.sinks import stored_days
from tests.helpers import plan, rows

START = dt.datetime(2024, 3, 1)
HORIZONS = {"1d": 1, "3d": 3, "20d": 20}


# --- ticks -------------------------------------------------------------------
@pytest.fixture(scope="module")
def market_ticks(spark):
    """Twelve days, some without ticks, a hot asset, ticks at equal times and at midnight."""
    rng = random.Random(5)
    out = []
    for day in (0, 1, 2, 5, 6, 7, 11):
        for _ in range(120):
            asset = "hot" if rng.random() < 0.4 else rng.choice("abcdefg")
            if asset == "g" and day != 2:
                continue
            second = rng.choice([0, 0, 86_399, rng.randrange(86_400)])
            at = START + dt.timedelta(days=day, seconds=second)
            out.append((asset, at, rng.choice([1.5, 2.25, rng.uniform(1, 9), None])))
    out += [("hot", START + dt.timedelta(days=11, hours=23), 3.0)] * 5
    return spark.createDataFrame(out, "id string, ts timestamp, value double")


def expected(market_ticks, day):
    end = F.lit(day).cast("timestamp") + F.expr("interval 1 day") - F.expr("interval 1 microsecond")
    spans = {h: f"{n} days" for h, n in HORIZONS.items()}
    return ticks.snapshot(market_ticks.where(F.col("ts") <= end), spans, now=end)


def test_last_of_equal_times_is_the_largest(spark):
    at = dt.datetime(2024, 1, 1)
    made = [("a", at, 2.0), ("a", at, 7.0), ("a", at, 3.0), ("b", at, None), ("b", at, 1.0)]
    for shuffled in (made, made[::-1], made[2:] + made[:2]):
        df = spark.createDataFrame(shuffled, "id string, ts timestamp, value double").repartition(3)
        snap = ticks.snapshot(df, {"24h": "1 day"})
        assert rows(snap, "id", "current_price") == [("a", 7.0), ("b", 1.0)]
        assert rows(ticks.daily_prices(df), "id", "close") == [("a", 7.0), ("b", 1.0)]


@pytest.mark.parametrize("since", [None, "2024-03-06"])
def test_snapshots_day_by_day(spark, market_ticks, folder, since):
    path = folder("ticks")
    days = sorted(str(r[0]) for r in market_ticks.select(F.to_date("ts")).distinct().collect())
    first = [d for d in days if since is None or d < since]
    batch = F.col("ts").cast("date").cast("string")
    tick_states.extend(spark, path, market_ticks.where(batch.isin(first)), since=since)
    for day in days[len(first):]:
        tick_states.extend(spark, path, market_ticks.where(batch == day))
    assert stored_days(spark, path, "day") == (days if since is None else [first[-1], *days[len(first):]])
    for day in days if since is None else days[-2:]:
        got = tick_states.snapshot_at(spark, path, day, HORIZONS)
        want = expected(market_ticks, day)
        if since is not None:  # horizons before the first state are unknown
            got, want = got.drop("change_pct_20d", "change_20d"), want.drop("change_pct_20d", "change_20d")
        assert rows(got.select(*want.columns)) == rows(want), day


def test_a_new_day_reads_one_state(spark, market_ticks, folder):
    path = folder("ticks")
    day = F.col("ts").cast("date")
    tick_states.extend(spark, path, market_ticks.where(day < "2024-03-12"))
    old = {d: files.names(spark, f"{path}/day={d}") for d in stored_days(spark, path, "day")}
    tick_states.extend(spark, path, market_ticks.where(day == "2024-03-12"))
    assert all(files.names(spark, f"{path}/day={d}") == held for d, held in old.items())
    snap = tick_states.snapshot_at(spark, path, "2024-03-12", {"1d": 1})
    assert {r.rpartition("/")[0].rpartition("=")[2] for r in snap.inputFiles()} == {
        "2024-03-08", "2024-03-12",
    }
    # a day without ticks has the marks of the day before and no range of its own
    quiet = tick_states.snapshot_at(spark, path, "2024-03-10", {"1d": 1})
    assert {r["high_24h"] for r in quiet.collect()} == {None}
    assert quiet.count() == 8
    with pytest.raises(ValueError):
        tick_states.snapshot_at(spark, path, "2024-02-01", {})


def test_a_restated_day_and_those_after_it(spark, market_ticks, folder):
    path = folder("ticks")
    tick_states.extend(spark, path, market_ticks)
    day = F.col("ts").cast("date")
    doubled = F.when(day == "2024-03-06", F.col("value") * 2).otherwise(F.col("value"))
    restated = market_ticks.withColumn("value", doubled)
    tick_states.extend(spark, path, restated.where(day >= "2024-03-06"))
    got = tick_states.snapshot_at(spark, path, "2024-03-12", HORIZONS)
    want = expected(restated, "2024-03-12")
    assert rows(got.select(*want.columns)) == rows(want)


# --- sketches ----------------------------------------------------------------
def test_sketches_merge(spark, folder):
    n = F.col("id")
    df = spark.range(60_000).select(
        F.when(n % 3 == 0, "hot").otherwise((n % 7).cast("string")).alias("day"),
        F.pmod(F.xxhash64(n), F.lit(20_000)).alias("many"),
        (n % 5).cast("double").alias("few"),
        F.lit(None).cast("string").alias("none"),
    )
    columns = ["many", "few", "none"]
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    path = folder("sketches")
    sketches.distinct_states(df, columns, ["day"]).write.partitionBy("day").parquet(path)
    states = spark.read.parquet(path)
    once = sketches.estimates(sketches.merged(states, columns), columns).first()
    # merged in two steps, and from another split of the rows
    halves = sketches.merged(states.withColumn("half", F.col("day") > "3"), columns, ["half"])
    twice = sketches.estimates(sketches.merged(halves, columns), columns).first()
    other = sketches.distinct_states(df.withColumn("s", F.col("many") % 4), columns, ["s"])
    third = sketches.estimates(sketches.merged(other, columns), columns).first()
    assert once == twice == third
    single = sketches.estimates(sketches.distinct_states(df, columns), columns).first()
    for found in (once, single):
        assert found["few"] == 5
        assert found["none"] == 0
        assert abs(found["many"] / exact["many"] - 1) < 4 * sketches.relative_error()
    assert "Scan parquet" in plan(sketches.merged(states, columns))


@pytest.mark.parametrize("precision", [8, 11, 14])
def test_the_error_of_sketches(spark, precision):
    """Over 60 disjoint groups, the mean square error is that of the registers."""
    df = spark.range(60 * 5_000).select((F.col("id") % 60).alias("g"), F.col("id").alias("x"))
    found = sketches.estimates(sketches.distinct_states(df, ["x"], ["g"], precision), ["x"])
    off = [r["x"] / 5_000 - 1 for r in found.collect()]
    deviation = (sum(e * e for e in off) / len(off)) ** 0.5
    assert deviation < 1.5 * sketches.relative_error(precision)


# --- quality -----------------------------------------------------------------
def split(df, parts):
    numbered = df.withColumn("_p", F.pmod(F.xxhash64("*", F.monotonically_increasing_id()), F.lit(parts)))
    stored = materialised(numbered)
    return [stored.where(F.col("_p") == i).drop("_p") for i in range(parts)]


def test_every_verdict_from_merged_states(spark, market, folder):
    market.store(*ALL_TABLES)
    tables = {name: market.stored(name) for name in ALL_TABLES}
    every = checks.all_checks(tables, market.now)
    assert sum(map(len, every.values())) == 321
    root = folder("states")
    for name, df in tables.items():
        for i, part in enumerate(split(df, 3)):
            qs.add_day(part, every[name], f"{root}/{name}", f"2024-01-0{i + 1}")
    got = qs.suites_from_states(spark, root, every)
    assert rows(got) == rows(checks.run_checks(tables, market.now))


def test_states_of_broken_tables(spark, folder):
    made = [
        (dt.date(2024, 1, 1 + i % 3), f"k{i % 4}", float(i % 6), i, None if i == 5 else "x")
        for i in range(30)
    ]
    df = spark.createDataFrame(made, "d date, k string, v double, t int, s string")
    own = [
        q.violation("v below 5", F.col("v") >= 5),
        q.count("rows", ">=", 31),
        q.total("sum of v", "v", 75.0, 0.5),
        q.distinct("days", "d", "=", 3),
        q.unique("keys once", "k"),
        q.latest_count("rows of the last day", "d", "=", 10),
        q.latest_unique("keys of the last day", "d", "k"),
        q.ordered("t rises with d", "d", "t"),
        q.groups("hot keys", ["k"], "=", 0, F.col("_n") > 7),
        q.groups("peaks", ["k"], "=", 0, F.col("_top") > 4, {"_top": F.max("v")}),
        *q.Contract(optional=("s",), unique=("t",)).checks(df.columns),
    ]
    whole = rows(q.dq_suite("t", df, own))
    assert {r[-1] for r in whole} == {True, False}
    for name, parts in {
        "days": [df.where(F.col("d") == d) for d in ("2024-01-02", "2024-01-01", "2024-01-03")],
        "parts": [*split(df, 4), df.limit(0)],
    }.items():
        path = folder(name)
        for i, part in enumerate(parts):
            qs.add_day(part, own, path, f"2024-02-0{i + 1}")
        assert rows(qs.dq_from_states(spark, "t", path, own)) == whole, name
        # a day that is added again replaces itself, and an emptied one leaves nothing
        qs.add_day(parts[0], own, path, "2024-02-01")
        assert rows(qs.dq_from_states(spark, "t", path, own)) == whole
        qs.add_day(parts[1].limit(0), own, path, "2024-02-02")
        rest = parts[0]
        for part in parts[2:]:
            rest = rest.unionAll(part)
        assert rows(qs.dq_from_states(spark, "t", path, own)) == rows(q.dq_suite("t", rest, own))


def test_an_append_reads_its_own_rows(spark, folder):
    path, table = folder("states"), folder("table")
    spark.range(1000).select(F.col("id").alias("x")).write.parquet(table)
    own = [q.unique("once", "x"), q.violation("low", F.col("x") > 5_000)]
    qs.add_day(spark.read.parquet(table), own, path, "2024-01-01")
    qs.add_day(spark.range(990, 1100).select(F.col("id").alias("x")), own, path, "2024-01-02")
    found = qs.dq_from_states(spark, "t", path, own)
    assert rows(found, "check_name", "observed") == [("low", 0.0), ("once", 10.0)]
    assert not any(f.startswith(f"file:{table}") or table in f for f in found.inputFiles())
