"""Staged tables and marts on small frames worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tidemark.plans import marts, reports, staging
from tidemark.sources.schemas import ASSET_COLUMNS

_SCHEMA = ", ".join(f"{c} {t}" for c, t in ASSET_COLUMNS.items()) + ", ingested_at timestamp_ntz"
AS_OF = "2024-03-01 00:00:00"


def raw(spark, *assets):
    names = [*ASSET_COLUMNS, "ingested_at"]
    return spark.createDataFrame([tuple(a.get(n) for n in names) for a in assets], _SCHEMA)


def asset(i, **values):
    base = {
        "id": f"a{i}", "symbol": "s", "name": "n", "current_price": 10.0, "market_cap": 10**9,
        "market_cap_rank": i, "total_volume": 10.0**8, "high_24h": 11.0, "low_24h": 10.0,
        "price_change_percentage_24h": 1.0, "price_change_percentage_7d_in_currency": 7.0,
        "price_change_percentage_30d_in_currency": 30.0, "circulating_supply": 1.0,
        "max_supply": 4.0, "ath": 20.0, "ath_change_percentage": -50.0,
    }
    return base | values


def sentiment(spark, *values):
    start = dt.date(2024, 1, 1)
    data = [(x, "label", start + dt.timedelta(i), dt.datetime(2024, 2, 1)) for i, x in enumerate(values)]
    schema = "value long, value_classification string, timestamp_date date, ingested_at timestamp_ntz"
    return spark.createDataFrame(data, schema)


def totals(spark, *days):
    data = [(100.0, 20.0, 50.004, 20.004, 3, 4, 1.01, d, dt.datetime(2024, 2, 1)) for d in days]
    return spark.createDataFrame(
        data,
        "total_market_cap_usd double, total_volume_usd double, btc_dominance double, "
        "eth_dominance double, active_cryptocurrencies long, markets long, "
        "market_cap_change_24h_pct double, snapshot_date string, ingested_at timestamp_ntz",
    )


def test_enriched_asset(spark):
    got = staging.enrich_assets(raw(spark, asset(1))).first()
    assert (got.price_tier, got.volume_to_mcap_ratio) == ("mid_cap", 0.1)
    assert (got.distance_from_ath_pct, got.supply_ratio_pct) == (-50.0, 25.0)
    assert got.intraday_spread_pct == 10.0
    assert len(staging.enrich_assets(raw(spark)).columns) == 24


def test_defaults_and_invalid_prices(spark):
    blank = {c: None for c in asset(1) if c not in ("id", "current_price")}
    out = staging.enrich_assets(
        raw(
            spark,
            asset(1, **blank),
            asset(2, current_price=0.0),
            asset(3, current_price=None),
            asset(4, current_price=-1.0),
            asset(5, current_price=float("nan")),
        )
    ).collect()
    assert [r.id for r in out] == ["a1"]
    got = out[0]
    assert (got.market_cap, got.price_tier, got.volume_to_mcap_ratio) == (0, "micro_cap", 0.0)
    assert (got.intraday_spread_pct, got.high_24h, got.price_change_pct_7d) == (0.0, 0.0, 0.0)
    assert (got.supply_ratio_pct, got.max_supply, got.market_cap_rank) == (None, None, None)


def test_price_filter_reaches_the_scan(market):
    text = plan(staging.enrich_assets(market["raw_assets"]).select("id", "price_tier"))
    assert "GreaterThan(current_price,0.0)" in text
    read = text.split("ReadSchema: ")[1].split("\n")[0]
    assert read == "struct<id:string,current_price:double,market_cap:double>"


@pytest.mark.parametrize("slice_size", [1000, 3])
def test_sentiment_means_start_partial(spark, slice_size):
    df = staging.stage_sentiment(
        sentiment(spark, *range(10, 26)), slice_size=slice_size
    ).orderBy("timestamp_date")
    out = df.collect()
    assert [r.ma_7d for r in out[:3]] == [10.0, 10.5, 11.0]
    assert (out[15].ma_7d, out[15].ma_14d) == (22.0, 18.5)
    assert [r.daily_change for r in out[:2]] == [None, 1]


def test_global_rounding(spark):
    got = staging.stage_global(totals(spark, "2024-01-05")).first()
    # from the rounded shares the rest would be 30
    assert (got.btc_dominance, got.altcoin_dominance) == (50.0, 29.99)
    assert (got.global_volume_ratio, got.snapshot_date) == (0.2, dt.date(2024, 1, 5))


def test_dominance_ties_and_tiers(spark):
    assets = staging.enrich_assets(
        raw(
            spark,
            asset(1, market_cap=2 * 10**11),
            asset(2, market_cap=10**11),
            asset(3, market_cap=10**11),
            asset(4, market_cap=0),
        )
    )
    got = rows(
        marts.market_dominance(assets, AS_OF),
        "id", "dominance_pct", "rank_by_mcap", "tier_dominance_pct", "coins_in_tier",
    )
    assert got == [
        ("a1", 50.0, 1, 100.0, 3),
        ("a2", 25.0, 2, 100.0, 3),
        ("a3", 25.0, 2, 100.0, 3),
        ("a4", 0.0, 4, 0.0, 1),
    ]


def test_dominance_without_capital_is_null(spark):
    assets = staging.enrich_assets(raw(spark, asset(1, market_cap=0)))
    got = rows(marts.market_dominance(assets, AS_OF), "dominance_pct", "tier_dominance_pct")
    assert got == [(None, None)]


def test_volatility_score_and_unrounded_tier(spark):
    # .3*24h + .3*spread + .2*7d/7 + .2*30d/30 = 0.3 + 3 + 0.2 + 0.2
    assets = staging.enrich_assets(
        raw(
            spark,
            asset(1),
            asset(2, price_change_percentage_24h=-38.68),
            asset(51),
            asset(3, market_cap_rank=None),
        )
    )
    out = marts.volatility_analysis(assets, AS_OF)
    assert rows(out, "id", "volatility_score", "volatility_tier") == [
        ("a1", 3.7, "moderate"),
        ("a2", 15.0, "ultra_volatile"),  # 15.004 before rounding
    ]


def test_momentum_and_missing_sentiment(spark):
    assets = staging.enrich_assets(raw(spark, asset(1, price_change_percentage_24h=6.0), asset(51)))
    # 20 + 12 + 12 + 0 + 0
    staged = staging.stage_sentiment(sentiment(spark, 90, 10))
    out = marts.momentum_signals(assets, staged, AS_OF)
    columns = ["id", "momentum_score", "fear_greed_index", "signal", "signal_confidence"]
    assert rows(out, *columns) == [("a1", 44.0, 10, "BUY", "MEDIUM")]
    assert marts.momentum_signals(assets, staged.limit(0), AS_OF).count() == 0


def test_regime_by_hand(spark):
    assets = staging.enrich_assets(
        raw(
            spark,
            asset(1),
            asset(2, price_change_percentage_24h=-2.0),
            asset(3, price_change_percentage_7d_in_currency=0.0),
            asset(99, price_change_percentage_24h=-50.0),
        )
    )
    staged = staging.stage_sentiment(sentiment(spark, 50, 80))
    market = staging.stage_global(totals(spark, "2024-01-04", "2024-01-05"))
    got = marts.market_regime(assets, staged, market, AS_OF).first()
    # (66.67-50)*.2 + (66.67-50)*.3 + 50*.3 + 20*.2 = 27.3
    assert (got.regime_score, got.regime) == (27.3, "STRONG_BULL")
    assert (got.coins_analyzed, got.pct_up_24h, got.pct_up_30d) == (3, 66.7, 100.0)
    assert (got.avg_change_24h, got.fear_greed_current, got.fear_greed_ma_7d) == (0.0, 80, 65.0)
    assert got.analysis_date == dt.date(2024, 3, 1)
    assert got.regime_narrative.startswith("Strong bullish")


def test_regime_on_empty_inputs(spark):
    none = staging.enrich_assets(raw(spark))
    staged = staging.stage_sentiment(sentiment(spark, 50))
    market = staging.stage_global(totals(spark, "2024-01-05"))
    got = marts.market_regime(none, staged, market, AS_OF).first()
    assert (got.coins_analyzed, got.regime_score, got.regime) == (0, None, "STRONG_BEAR")
    assert marts.market_regime(none, staged.limit(0), market, AS_OF).count() == 0
    assert marts.market_regime(none, staged, market.limit(0), AS_OF).count() == 0


def test_zone_of_one_day_has_no_deviation(spark):
    staged = staging.stage_sentiment(sentiment(spark, 10, 20, 90))
    out = rows(
        marts.zone_impact(staged, AS_OF),
        "sentiment_zone", "days_count", "std_dev", "pct_of_total_days", "current_zone",
    )
    assert out == [
        ("extreme_fear", 2, 7.1, 66.7, "extreme_greed"),
        ("extreme_greed", 1, 0.0, 33.3, "extreme_greed"),
    ]


def test_category_flag_keeps_unmatched(spark):
    assets = staging.enrich_assets(raw(spark, asset(1), asset(2)))
    categories = spark.createDataFrame(
        [("a1", "Stablecoin", "x")], "coin_id string, category string, subcategory string"
    )
    out = rows(reports.category_enrich(assets, categories), "id", "category", "is_stable")
    assert out == [("a1", "Stablecoin", True), ("a2", None, False)]


def test_marts_read_single_rows_not_cross_joins(market):
    for name in ("market_regime", "momentum_signals", "zone_impact", "market_dominance"):
        text = plan(market[name])
        assert "CartesianProduct" not in text, name
        assert "NestedLoopJoin" not in text, name


def test_distinct_counts_exact_and_approximate(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.lit(None).alias("b"))
    assert rows(reports.distinct_counts(df, ["a", "b"])) == [("a", 10), ("b", 0)]
    assert rows(reports.distinct_counts(df, ["a", "b"], approximate=True)) == [("a", 10), ("b", 0)]
