"""Staged tables to analytics marts.

``as_of`` stamps the rows; pass a date column or text, or None for today.
None of the marts is sorted: order by what a report shows when it is shown.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.functions.bands import Bands, banded
from tidemark.functions.dates import instant
from tidemark.functions.exact import exact_mean, exact_total
from tidemark.functions.ratios import share_pct
from tidemark.functions.scores import contrarian_signal, crossover, scorecard, weighted_score
from tidemark.operators.latest import with_latest
from tidemark.operators.lookups import broadcast_if_small
from tidemark.operators.ordering import attach_rank, occurrence_in_group
from tidemark.operators.shares import group_share, share_of_total
from tidemark.operators.topk import top_k_both_ways
from tidemark.session import materialised

AsOf = Column | dt.datetime | str | None


def _day(as_of: AsOf) -> Column:
    return instant(as_of).cast("date")


def rank_cutoff(df: DataFrame, n: int, rank: str = "market_cap_rank") -> DataFrame:
    """The ``n`` largest by a given rank; a NULL rank drops out."""
    return df.filter(F.col(rank) <= n)


# --- dominance ---------------------------------------------------------------
def tier_summary(assets: DataFrame) -> DataFrame:
    """Assets, capital and share of all capital per size tier."""
    return group_share(
        assets,
        ["price_tier"],
        "market_cap",
        "tier_dominance_pct",
        2,
        {
            "coin_count": F.count("*"),
            "tier_market_cap": exact_total("market_cap"),
        },
    )


def market_dominance(assets: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Each asset's share of all capital and its rank, beside its tier's share.

    The assets are read twice: once reduced to one row per tier and distinct
    capital, from which total, tiers and ranks follow, and once for the rows.
    """
    base = assets.select("id", "name", "symbol", "market_cap", "price_tier")
    sizes = materialised(
        base.groupBy("price_tier", "market_cap").agg(F.count("*").alias("ties"))
    ).withColumn("capital", F.col("market_cap").cast("double") * F.col("ties"))
    total = sizes.agg(exact_total("capital")).scalar()
    # one row per tier label, a handful unless a caller brings other labels
    tiers = broadcast_if_small(
        share_of_total(
            sizes.groupBy("price_tier").agg(
                exact_total("capital").alias("capital"), F.sum("ties").alias("coins_in_tier")
            ),
            "capital",
            "tier_dominance_pct",
            2,
            total,
        ).drop("capital")
    )
    per_value = sizes.groupBy("market_cap").agg(F.sum("ties").alias("ties"))
    shared = share_of_total(base, "market_cap", "dominance_pct", 4, total)
    ranked = attach_rank(shared, per_value, "market_cap", "ties", "rank_by_mcap")
    return ranked.join(tiers, "price_tier", "left").select(
        _day(as_of).alias("snapshot_date"),
        "id",
        "name",
        "symbol",
        "market_cap",
        "dominance_pct",
        "rank_by_mcap",
        "price_tier",
        "tier_dominance_pct",
        "coins_in_tier",
    )


# --- volatility --------------------------------------------------------------
def abs_changes(df: DataFrame, horizons: Sequence[str] = v.HORIZONS) -> DataFrame:
    return df.withColumns(
        {f"abs_change_{h}": F.abs(f"price_change_pct_{h}") for h in horizons}
    )


def volatility_analysis(
    assets: DataFrame,
    as_of: AsOf = None,
    major: int = v.MAJOR_ASSETS,
    weights: Sequence[tuple[str, float, float]] = v.VOLATILITY_WEIGHTS,
    tiers: Bands = v.VOLATILITY_TIERS,
    activity: Bands = v.VOLUME_ACTIVITY,
) -> DataFrame:
    """Weighted absolute movement of the major assets, with tier and volume activity.

    The tier is taken from the unrounded score.
    """
    scored = abs_changes(rank_cutoff(assets, major)).withColumn("_raw", weighted_score(weights))
    return scored.select(
        _day(as_of).alias("analysis_date"),
        "id",
        "name",
        "symbol",
        "market_cap_rank",
        "price_tier",
        "current_price",
        "intraday_spread_pct",
        "abs_change_24h",
        "abs_change_7d",
        "abs_change_30d",
        F.round("_raw", 2).alias("volatility_score"),
        banded(F.col("_raw"), tiers).alias("volatility_tier"),
        "distance_from_ath_pct",
        "volume_to_mcap_ratio",
        banded(F.col("volume_to_mcap_ratio"), activity).alias("volume_activity_level"),
    )


# --- momentum ----------------------------------------------------------------
def momentum_signals(
    assets: DataFrame,
    sentiment: DataFrame,
    as_of: AsOf = None,
    major: int = v.MAJOR_ASSETS,
    ladders: Mapping[str, Bands] = v.MOMENTUM_LADDERS,
    rules: Sequence[tuple[float, float | None, str]] = v.SIGNALS,
    otherwise: str = v.SIGNAL_OTHERWISE,
    confidence: Bands = v.CONFIDENCE,
) -> DataFrame:
    """Momentum scorecard of the major assets, read against today's sentiment.

    Without any sentiment row there is no signal, hence no row.
    """
    scored = rank_cutoff(assets, major).withColumn("momentum_score", scorecard(ladders))
    placed = with_latest(
        scored,
        sentiment,
        "timestamp_date",
        {"fear_greed_index": "value", "market_sentiment": "classification"},
    )
    score = F.col("momentum_score")
    return placed.select(
        _day(as_of).alias("analysis_date"),
        "id",
        "name",
        "symbol",
        "current_price",
        "market_cap_rank",
        "price_tier",
        "price_change_pct_24h",
        "price_change_pct_7d",
        "price_change_pct_30d",
        "volume_to_mcap_ratio",
        "distance_from_ath_pct",
        "momentum_score",
        "fear_greed_index",
        "market_sentiment",
        contrarian_signal(score, F.col("fear_greed_index"), rules, otherwise).alias("signal"),
        banded(F.abs(score), confidence).alias("signal_confidence"),
    )


# --- top performers ----------------------------------------------------------
def top_performers(
    assets: DataFrame,
    as_of: AsOf = None,
    ranked: int = v.RANKED_ASSETS,
    k: int = v.TOP_K,
    horizons: Sequence[str] = v.HORIZONS,
) -> DataFrame:
    """Largest gains and losses per horizon among the ranked assets.

    Ranked on the unrounded change; equal changes are ordered by id.
    """
    columns = ["id", "name", "symbol", "current_price", "market_cap_rank", "price_tier"]
    measures = {h: f"price_change_pct_{h}" for h in horizons}
    pool = rank_cutoff(assets, ranked).select(*columns, *measures.values())
    return top_k_both_ways(pool, measures, "id", k).select(
        _day(as_of).alias("analysis_date"),
        *columns,
        "timeframe",
        F.round("change_pct", 2).alias("change_pct"),
        "performance_category",
        "rank_in_category",
    )


# --- sentiment zones ---------------------------------------------------------
def with_trend(sentiment: DataFrame, fast: str = "ma_7d", slow: str = "ma_14d") -> DataFrame:
    return sentiment.withColumn("sentiment_trend", crossover(F.col(fast), F.col(slow)))


def days_in_zone(sentiment: DataFrame) -> DataFrame:
    """Running count of the days spent in each zone so far."""
    return occurrence_in_group(sentiment, "sentiment_zone", ["timestamp_date"], "days_in_zone")


def zone_statistics(sentiment: DataFrame) -> DataFrame:
    """Days, level, spread and share of time per zone (one day: deviation 0)."""
    return group_share(
        sentiment,
        ["sentiment_zone"],
        None,
        "pct_of_total_days",
        1,
        {
            "days_count": F.count("*"),
            "avg_index_value": exact_mean("value", 1),
            "min_value": F.min("value"),
            "max_value": F.max("value"),
            "std_dev": F.coalesce(F.round(F.stddev_samp("value"), 1), F.lit(0.0)),
        },
    )


def trend_summary(sentiment: DataFrame) -> DataFrame:
    """Days and average level per trend direction."""
    return (
        with_trend(sentiment)
        .groupBy("sentiment_trend")
        .agg(
            F.count("*").alias("trend_days"),
            exact_mean("value", 1).alias("avg_value_during_trend"),
        )
    )


def zone_impact(sentiment: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Zone statistics with the current level, zone, mean and trend beside them."""
    current = {
        "current_value": "value",
        "current_zone": "sentiment_zone",
        "current_ma_7d": "ma_7d",
        "current_trend": "sentiment_trend",
    }
    stats = zone_statistics(sentiment)
    placed = with_latest(
        stats, with_trend(sentiment), "timestamp_date", current, required=False
    )
    return placed.select(
        _day(as_of).alias("analysis_date"),
        "sentiment_zone",
        "days_count",
        "avg_index_value",
        "min_value",
        "max_value",
        "std_dev",
        "pct_of_total_days",
        *current,
    )


# --- regime ------------------------------------------------------------------
def market_breadth(
    assets: DataFrame, major: int = v.MAJOR_ASSETS, horizons: Sequence[str] = v.HORIZONS
) -> DataFrame:
    """One row: how many major assets rose and fell per horizon, and average moves."""

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    moves = {h: F.col(f"price_change_pct_{h}") for h in horizons}
    return rank_cutoff(assets, major).agg(
        F.count("*").alias("total_coins"),
        *[counted(c > 0).alias(f"up_{h}") for h, c in moves.items()],
        *[counted(c < 0).alias(f"down_{h}") for h, c in moves.items()],
        *[exact_mean(c, 2).alias(f"avg_change_{h}") for h, c in moves.items()],
        exact_mean("volume_to_mcap_ratio", 4).alias("avg_volume_ratio"),
    )


def market_regime(
    assets: DataFrame,
    sentiment: DataFrame,
    global_metrics: DataFrame,
    as_of: AsOf = None,
    major: int = v.MAJOR_ASSETS,
    breadth_weights: Mapping[str, float] = v.BREADTH_WEIGHTS,
    sentiment_weight: float = v.SENTIMENT_WEIGHT,
    points: Bands = v.SENTIMENT_POINTS,
    regimes: Bands = v.REGIMES,
    narratives: Mapping[str, str] = v.NARRATIVES,
) -> DataFrame:
    """One row: breadth and sentiment combined into a labelled market state.

    No asset at all gives a NULL score, which falls to the last label; no
    sentiment or no market totals gives no row.
    """
    state = market_breadth(assets, major, list(breadth_weights))
    state = with_latest(
        state,
        sentiment,
        "timestamp_date",
        {
            "fear_greed_current": "value",
            "fear_greed_ma_7d": "ma_7d",
            "sentiment_zone": "sentiment_zone",
        },
    )
    state = with_latest(
        state,
        global_metrics,
        "snapshot_date",
        {
            c: c
            for c in ("market_cap_change_24h_pct", "btc_dominance", "altcoin_dominance")
        },
    )
    up = {h: share_pct(F.col(f"up_{h}"), F.col("total_coins")) for h in breadth_weights}
    terms = [(up[h] - F.lit(50.0)) * F.lit(w) for h, w in breadth_weights.items()]
    mood = banded(F.col("fear_greed_current"), points) * F.lit(sentiment_weight)
    scored = state.withColumn("regime_score", F.round(reduce(add, [*terms, mood]), 1))
    label = banded(F.col("regime_score"), regimes)
    story = F.create_map(*[F.lit(t) for pair in narratives.items() for t in pair])
    return scored.select(
        _day(as_of).alias("analysis_date"),
        label.alias("regime"),
        "regime_score",
        F.col("total_coins").alias("coins_analyzed"),
        *[F.round(up[h], 1).alias(f"pct_up_{h}") for h in breadth_weights],
        *[f"avg_change_{h}" for h in breadth_weights],
        "fear_greed_current",
        "fear_greed_ma_7d",
        "sentiment_zone",
        "market_cap_change_24h_pct",
        "btc_dominance",
        "altcoin_dominance",
        "avg_volume_ratio",
        F.try_element_at(story, label).alias("regime_narrative"),
    )
