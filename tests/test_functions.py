"""Hand-computed values on every edge."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark import fixed_values as v
from tidemark.functions import dates, ratios, scores
from tidemark.functions.bands import banded, mislabelled


def labels(spark, bands, values):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    out = df.select("i", banded(F.col("x"), bands).alias("label")).orderBy("i").collect()
    return [r.label for r in out]


@pytest.mark.parametrize(
    ("bands", "values", "expected"),
    [
        (
            v.SIZE_TIERS,
            [1e11, 1e11 - 1, 1e10, 1e9, 1e8, 1e8 - 1, 0.0, None],
            ["mega_cap", "large_cap", "large_cap", "mid_cap", "small_cap"] + ["micro_cap"] * 3,
        ),
        (
            v.SENTIMENT_ZONES,
            [0.0, 25.0, 26.0, 45.0, 46.0, 55.0, 56.0, 75.0, 76.0, None],
            ["extreme_fear", "extreme_fear", "fear", "fear", "neutral", "neutral", "greed"]
            + ["greed", "extreme_greed", "extreme_greed"],
        ),
        (
            v.SENTIMENT_POINTS,
            [75.0, 74.0, 55.0, 54.0, 45.0, 44.0, 25.0, 24.0],
            [20, 10, 10, 0, 0, -10, -10, -20],
        ),
        (
            v.VOLATILITY_TIERS,
            [15.0001, 15.0, 8.0, 3.0, 1.0],
            ["ultra_volatile", "high", "moderate", "low", "stable"],
        ),
        (
            v.VOLUME_ACTIVITY,
            [0.51, 0.5, 0.2, 0.05],
            ["abnormally_high", "elevated", "normal", "low"],
        ),
        (v.CONFIDENCE, [50.1, 50.0, 25.0], ["HIGH", "MEDIUM", "LOW"]),
        (
            v.REGIMES,
            [25.0, 24.9, 10.0, 9.9, -10.0, -10.1, -25.0, -25.1, None],
            ["STRONG_BULL", "BULL", "BULL", "NEUTRAL", "NEUTRAL", "BEAR", "BEAR"]
            + ["STRONG_BEAR", "STRONG_BEAR"],
        ),
    ],
)
def test_band_edges(spark, bands, values, expected):
    assert labels(spark, bands, values) == expected


@pytest.mark.parametrize(
    ("column", "values", "expected"),
    [
        ("price_change_pct_24h", [5.1, 5.0, 0.0, -4.9, -5.0], [20, 10, 0, 0, -10]),
        ("price_change_pct_7d", [15.1, 15.0, 0.0, -9.9, -10.0], [25, 12, 0, 0, -12]),
        ("price_change_pct_30d", [30.1, 30.0, 0.0, -19.9, -20.0], [25, 12, 0, 0, -12]),
        ("volume_to_mcap_ratio", [0.31, 0.3, 0.1], [15, 8, 0]),
        ("distance_from_ath_pct", [-19.9, -20.0, -49.9, -50.0], [15, 8, 8, 0]),
    ],
)
def test_momentum_ladders(spark, column, values, expected):
    assert labels(spark, v.MOMENTUM_LADDERS[column], values) == expected


def test_scorecard_reaches_both_ends(spark):
    df = spark.createDataFrame(
        [("up", 9.0, 20.0, 40.0, 0.5, -1.0), ("down", -9.0, -20.0, -40.0, 0.0, -90.0)],
        ["id", *v.MOMENTUM_LADDERS],
    )
    out = df.select("id", scores.scorecard(v.MOMENTUM_LADDERS).alias("s"))
    assert rows(out) == [("down", -34.0), ("up", 100.0)]
    assert out.schema["s"].dataType.simpleString() == "double"


def test_signal_needs_fear_for_strong_buy(spark):
    df = spark.createDataFrame(
        [(60.0, 29), (60.0, 30), (40.0, 0), (39.9, 0), (-10.0, 0), (-10.1, 0), (-40.1, 0)],
        "score double, mood int",
    )
    signal = scores.contrarian_signal(
        F.col("score"), F.col("mood"), v.SIGNALS, v.SIGNAL_OTHERWISE
    )
    assert [r[0] for r in df.select(signal).collect()] == [
        "STRONG_BUY", "BUY", "BUY", "NEUTRAL", "NEUTRAL", "SELL", "STRONG_SELL",
    ]


def test_guarded_ratios(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0), (1.0, 0.0), (1.0, None), (None, 2.0), (1.0, -1.0)], "a double, b double"
    )
    a, b = F.col("a"), F.col("b")
    out = df.select(
        ratios.safe_ratio(a, b, 4).alias("plain"),
        ratios.safe_ratio(a, b, 2, 100.0, otherwise=None, guard=a > 0).alias("both"),
        ratios.share_pct(a, b).alias("share"),
        ratios.change_pct(a, b).alias("change"),
    ).collect()
    assert [r.plain for r in out] == [0.3333, 0.0, 0.0, None, 0.0]
    assert [r.both for r in out] == [33.33, None, None, None, None]
    assert [r.share for r in out][1:3] == [None, None]
    assert [r.change for r in out][1:3] == [None, None]


def test_remainder_uses_unrounded_shares(spark):
    df = spark.createDataFrame([(40.004, 20.004)], "a double, b double")
    out = df.select(ratios.remainder_pct(F.col("a"), F.col("b"))).first()[0]
    assert out == 39.99  # 100 - 40 - 20 would be 40


def test_default_nulls_and_crossover(spark):
    df = spark.createDataFrame([(None, 2.0), (3.0, 3.0), (4.0, 3.0), (1.0, 3.0)], "a double, b double")
    assert rows(ratios.default_nulls(df, ["a"]), "a") == [(0.0,), (1.0,), (3.0,), (4.0,)]
    assert [r[0] for r in df.select(scores.crossover(F.col("a"), F.col("b"))).collect()] == [
        "flat", "flat", "improving", "deteriorating",
    ]


def test_days_do_not_follow_the_session_zone(spark):
    df = spark.createDataFrame([(1704067199,), (1704067200,), (-1,)], "s long")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [str(r[0]) for r in df.select(dates.utc_day(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2023-12-31", "2024-01-01", "1969-12-31"]


def test_bad_text_is_no_date(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("x",)], "t string")
    assert [str(r[0]) for r in df.select(dates.try_day(F.col("t"))).collect()] == [
        "None", "2024-02-29", "None",
    ]


def test_mislabelled_does_not_judge_unknown_labels(spark):
    df = spark.createDataFrame(
        [("fear", 25), ("fear", 26), ("fear", None), ("other", 3), (None, 3)],
        "zone string, x int",
    )
    wrong = mislabelled(F.col("zone"), F.col("x"), v.SENTIMENT_ZONES)
    assert df.filter(wrong).count() == 1
