from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows, same
from tidemark.operators import latest, lookups, shares, ticks, topk
from tidemark.session import materialised


# --- lookups -----------------------------------------------------------------
@pytest.mark.parametrize("broadcast_bytes", [10_000_000, 10])
def test_summary_join_with_hot_and_cold_keys(spark, broadcast_bytes):
    n = F.col("id")
    key = F.when(n % 3 == 0, -1).when(n % 97 != 0, (n % 2000).cast("int"))
    df = spark.range(30_000).withColumn("k", key)
    summary = {"n": F.count("*"), "m": F.max("id")}
    got = lookups.join_group_summary(df, "k", summary, broadcast_bytes, hot_keys=10)
    per = df.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    naive = df.join(per.withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2")))
    assert got.count() == 30_000
    assert same(got, naive.drop("k2"))


def test_broadcast_only_below_the_bound(spark):
    small, fact = spark.range(10), spark.range(1000)
    assert lookups.measured_bytes(small) == 10 * (32 + 8)
    joined = fact.join(lookups.broadcast_if_small(small, 400), "id")
    assert "BroadcastHashJoin" in plan(joined)
    hinted = lookups.broadcast_if_small(small, 399)
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()


def test_the_width_of_rows_counts(spark):
    wide = spark.range(50).select(
        "id",
        F.repeat(F.lit("é"), 10_000).alias("text"),
        F.array(F.lit(1), F.lit(2)).alias("numbers"),
        F.lit(None).cast("string").alias("nothing"),
        F.lit(1).cast("decimal(38,2)").alias("price"),
    )
    assert 50 * 20_000 < lookups.measured_bytes(wide) < 50 * 20_200
    assert lookups.measured_bytes(wide.limit(0)) == 0
    detail = spark.range(2_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("id"))
    per_key = materialised(
        wide.join(detail.groupBy("id").agg(F.count("*").alias("n")), "id", "left").fillna(0, ["n"])
    )
    ways = {}
    # what the planner makes of the small compressed files is not asked here
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for limit in (10**7, 10**5):
        joined = lookups.join_per_key(detail, per_key.drop("numbers"), "id", "n", limit, hot_keys=20)
        ways[limit] = rows(joined.withColumn("text", F.length("text")))
        assert ("SortMergeJoin" in plan(joined) or "ShuffledHashJoin" in plan(joined)) == (
            limit == 10**5
        )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert ways[10**7] == ways[10**5]
    assert len(ways[10**5]) == 2_000


# --- shares ------------------------------------------------------------------
def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, x long")
    out = shares.share_of_total(df, "x", "pct", 2)
    assert rows(out, "id", "pct") == [("a", 33.33), ("b", 66.67), ("c", None)]
    zero = shares.share_of_total(df.filter("x IS NULL"), "x", "pct", 2)
    assert rows(zero, "pct") == [(None,)]


def test_integer_total_cannot_overflow(spark):
    df = spark.range(4).withColumn("x", F.lit(2**62))
    assert rows(shares.share_of_total(df, "x", "pct", 1), "pct") == [(25.0,)] * 4


def test_group_share(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "g string, x double")
    assert rows(shares.group_share(df, ["g"], "x", "p", 1), "g", "p") == [("a", 75.0), ("b", 25.0)]
    assert rows(shares.group_share(df, ["g"], None, "p", 1), "g", "p") == [("a", 66.7), ("b", 33.3)]


# --- latest ------------------------------------------------------------------
def test_latest_row_and_empty_source(spark):
    days = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 3), 3), (dt.date(2024, 1, 2), 2)],
        "d date, x int",
    )
    nothing = days.filter("x > 9")
    assert rows(latest.latest_row(days, "d", ["x"])) == [(3,)]
    assert latest.latest_row(nothing, "d", ["x"]).count() == 0
    df = spark.range(2)
    assert rows(latest.with_latest(df, days, "d", {"y": "x"})) == [(0, 3), (1, 3)]
    assert latest.with_latest(df, nothing, "d", {"y": "x"}).count() == 0
    kept = latest.with_latest(df, nothing, "d", {"y": "x"}, required=False)
    assert rows(kept) == [(0, None), (1, None)]


def test_latest_row_with_null_values_still_counts(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1), None)], "d date, x int")
    assert rows(latest.with_latest(spark.range(1), days, "d", {"y": "x"})) == [(0, None)]


def test_latest_slice(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "id string, run int")
    assert rows(latest.latest_slice(df, "run"), "id") == [("b",), ("c",)]
    assert latest.latest_slice(df.filter("run > 5"), "run").count() == 0


# --- top-k -------------------------------------------------------------------
def test_both_ways_against_a_union_of_branches(market):
    assets = market["assets"].select("id", "price_change_pct_24h", "price_change_pct_7d")
    measures = {"24h": "price_change_pct_24h", "7d": "price_change_pct_7d"}
    got = topk.top_k_both_ways(assets, measures, "id", 4)
    branches = []
    for label, column in measures.items():
        for way, order in (("gainer", F.desc(column)), ("loser", F.asc(column))):
            picked = assets.orderBy(order, "id").limit(4)
            branches.append(
                picked.select("id", F.lit(f"top_{way}_{label}").alias("c"), F.col(column).alias("v"))
            )
    union = branches[0].union(branches[1]).union(branches[2]).union(branches[3])
    picked = got.select("id", F.col("performance_category").alias("c"), F.col("change_pct").alias("v"))
    assert same(picked, union)


def test_fewer_rows_than_k_and_ties_by_id(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", -2.0)], "id string, x double")
    out = topk.top_k_both_ways(df, {"d": "x"}, "id", 10)
    assert rows(out, "performance_category", "rank_in_category", "id") == [
        ("top_gainer_d", 1, "a"),
        ("top_gainer_d", 2, "b"),
        ("top_gainer_d", 3, "c"),
        ("top_loser_d", 1, "c"),
        ("top_loser_d", 2, "a"),
        ("top_loser_d", 3, "b"),
    ]


def test_top_k_prunes_before_the_shuffle(market):
    text = plan(topk.top_k_both_ways(market["assets"], {"7d": "price_change_pct_7d"}, "id", 3))
    assert text.count("WindowGroupLimit") == 2
    assert "SinglePartition" not in text


def test_top_n_keeps_a_heap_per_task(market):
    text = plan(topk.top_n(market["assets"], F.col("market_cap"), "id", 3))
    assert "TakeOrderedAndProject" in text


def test_tagged_union(spark):
    df = spark.createDataFrame([(1,), (-1,), (0,), (None,)], "x int")
    out = topk.tagged_union(df, {"up": F.col("x") > 0, "not0": F.col("x") != 0}, "tag")
    assert rows(out) == [(-1, "not0"), (1, "not0"), (1, "up")]


# --- ticks -------------------------------------------------------------------
@pytest.fixture(scope="module")
def two_weeks(spark):
    start = dt.datetime(2024, 1, 1)
    data = [("a", start + dt.timedelta(days=i, hours=1), 10.0 + i) for i in range(10)]
    data += [("b", start + dt.timedelta(days=i), 5.0) for i in range(3)]
    return spark.createDataFrame(data, "id string, ts timestamp_ntz, value double")


def test_snapshot_by_hand(two_weeks):
    out = ticks.snapshot(two_weeks, {"1d": "1 day", "7d": "7 days", "30d": "30 days"})
    a, b = out.orderBy("id").collect()
    assert (a.current_price, a.high_24h, a.low_24h, a.total_volume) == (19.0, 19.0, 19.0, 19.0)
    assert (a.change_1d, a.change_7d, a.change_30d) == (1.0, 7.0, None)
    assert a.change_pct_7d == pytest.approx(7 / 12 * 100)
    assert (b.high_24h, b.total_volume, b.change_7d) == (None, None, 0.0)


def test_ticks_are_hash_aggregated(two_weeks):
    for df in (ticks.snapshot(two_weeks, {"1d": "1 day"}), ticks.daily_prices(two_weeks)):
        text = plan(df)
        assert "SortAggregate" not in text
        assert "partial_max" in text


def test_rolling_and_rsi_by_hand(two_weeks):
    daily = ticks.daily_prices(two_weeks)
    rolled = ticks.rolling_volatility(daily, (2,)).filter("id = 'a'").orderBy("day").collect()
    assert [r.volatility_2d for r in rolled][:2] == [None, None]
    assert rolled[2].volatility_2d == pytest.approx(0.6428, abs=1e-4)
    out = ticks.sma_rsi(daily).orderBy("id", "day").collect()
    rising = [r for r in out if r.id == "a"]
    flat = [r for r in out if r.id == "b"]
    assert (rising[0].rsi, rising[1].rsi) == (None, 100.0)
    assert rising[-1].sma_7 == 16.0
    assert [r.rsi for r in flat] == [None, 50.0, 50.0]


def test_zscore_and_correlation_of_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    assert rows(ticks.zscore(df, "a", "z"), "z") == [(None,)] * 3
    assert [r.z for r in ticks.zscore(df, "b", "z").collect()] == [-1.0, 0.0, 1.0]
    r = (
        df.withColumn("c", -F.col("b"))
        .select(
            ticks.correlation("a", "b").alias("none"), ticks.correlation("b", "c").alias("minus")
        )
        .first()
    )
    assert r.none is None and r.minus == pytest.approx(-1.0)


def test_correlation_matrix_ignores_days_one_side_lacks(spark):
    day = dt.date(2024, 1, 1)
    a, b = [1.0, 2.0, 4.0, 3.0], [2.0, 4.0, None, 6.0]
    data = [("a", day + dt.timedelta(i), x) for i, x in enumerate(a)]
    data += [("b", day + dt.timedelta(i), x) for i, x in enumerate(b) if x is not None]
    daily = spark.createDataFrame(data, "id string, day date, close double")
    leaders = spark.createDataFrame([("a", 1), ("b", 3)], "id string, position int")
    assert rows(ticks.correlation_matrix(daily, leaders, 4)) == [("a", "b", 1.0)]
