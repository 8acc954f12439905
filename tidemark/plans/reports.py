"""Questions asked of the finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.functions.exact import exact_mean
from tidemark.operators import ticks
from tidemark.operators.lookups import broadcast_if_small
from tidemark.operators.shares import group_share
from tidemark.operators.topk import top_n
from tidemark.plans.marts import tier_summary


def regime_brief(regime: DataFrame) -> DataFrame:
    return regime.select(
        "regime", "regime_score", "pct_up_24h", "pct_up_7d", "pct_up_30d", "regime_narrative"
    )


def top_momentum(momentum: DataFrame, n: int = 10) -> DataFrame:
    columns = ["id", "name", "momentum_score", "signal", "signal_confidence", "market_sentiment"]
    return top_n(momentum.select(*columns), F.col("momentum_score"), "id", n)


def zone_distribution(zones: DataFrame) -> DataFrame:
    return zones.select("sentiment_zone", "days_count", "pct_of_total_days", "current_trend")


def weekly_extremes(performers: DataFrame, k: int = 5, timeframe: str = "7d") -> DataFrame:
    return performers.filter(
        (F.col("timeframe") == timeframe) & (F.col("rank_in_category") <= k)
    ).select("performance_category", "rank_in_category", "id", "price_tier", "change_pct")


def with_category(assets: DataFrame, categories: DataFrame, how: str = "inner") -> DataFrame:
    """Assets with the category dimension beside them, broadcast if counted small."""
    dimension = broadcast_if_small(categories.withColumnRenamed("coin_id", "id"))
    return assets.join(dimension, "id", how)


def category_enrich(
    assets: DataFrame, categories: DataFrame, stable: str = "Stablecoin"
) -> DataFrame:
    """Category and a stablecoin flag; assets without a category are kept."""
    return with_category(assets, categories, "left").select(
        "id",
        "symbol",
        "price_tier",
        "category",
        "subcategory",
        F.coalesce(F.col("category") == stable, F.lit(False)).alias("is_stable"),
    )


def category_comparison(
    momentum: DataFrame, volatility: DataFrame, categories: DataFrame
) -> DataFrame:
    """Average scores and the mix of signals per category."""
    signals = [s for _, _, s in v.SIGNALS] + [v.SIGNAL_OTHERWISE]
    scores = momentum.select("id", "momentum_score", "signal").join(
        volatility.select("id", "volatility_score"), "id"
    )
    return (
        with_category(scores, categories)
        .groupBy("category")
        .agg(
            F.count("*").alias("assets"),
            exact_mean("momentum_score", 2).alias("avg_momentum"),
            exact_mean("volatility_score", 2).alias("avg_volatility"),
            *[F.count_if(F.col("signal") == s).alias(s.lower()) for s in signals],
        )
    )


def subcategory_performance(
    assets: DataFrame, categories: DataFrame, subcategories: list[str] | None = None
) -> DataFrame:
    """Average seven-day change per subcategory (all, or those to compare)."""
    dimension = categories
    if subcategories is not None:
        dimension = categories.filter(F.col("subcategory").isin(subcategories))
    joined = with_category(assets.select("id", "price_change_pct_7d"), dimension)
    return joined.groupBy("subcategory").agg(
        F.count("*").alias("assets"),
        exact_mean("price_change_pct_7d", 2).alias("avg_change_7d"),
    )


def volume_anomalies(volatility: DataFrame, above: float = 0.3) -> DataFrame:
    return volatility.filter(F.col("volume_to_mcap_ratio") > above).select(
        "id", "volume_to_mcap_ratio", "volume_activity_level", "volatility_tier"
    )


def contrarian_picks(momentum: DataFrame) -> DataFrame:
    """Strong buys while the market is fearful."""
    fearful = v.SENTIMENT_LABELS.labels[:2]
    return momentum.filter(
        (F.col("signal") == v.SIGNALS[0][2]) & F.col("market_sentiment").isin(fearful)
    ).select("id", "momentum_score", "signal_confidence", "fear_greed_index", "market_sentiment")


def dominance_by_tier(assets: DataFrame) -> DataFrame:
    """Share per tier, with the largest tier set against all others."""
    largest = v.SIZE_TIERS.labels[0]
    columns = ["price_tier", "coin_count", "tier_dominance_pct"]
    tiers = tier_summary(assets)
    side = F.when(F.col("price_tier") == largest, F.lit(largest)).otherwise(F.lit("others"))
    sides = group_share(
        tiers.withColumn("price_tier", side),
        ["price_tier"],
        "tier_market_cap",
        "tier_dominance_pct",
        2,
        {"coin_count": F.sum("coin_count")},
    )
    return tiers.select(F.lit("tier").alias("level"), *columns).unionByName(
        sides.select(F.lit("largest vs others").alias("level"), *columns)
    )


def freshness(assets: DataFrame) -> DataFrame:
    return assets.agg(F.max("ingested_at").alias("latest_ingested_at"))


def tier_counts(assets: DataFrame) -> DataFrame:
    return assets.groupBy("price_tier").agg(F.count("*").alias("assets"))


def top_spread(assets: DataFrame, n: int = 10) -> DataFrame:
    columns = ["id", "name", "intraday_spread_pct"]
    return top_n(assets.select(*columns), F.col("intraday_spread_pct"), "id", n)


def signal_cohorts(momentum: DataFrame) -> DataFrame:
    """Average size rank of assets to buy and to sell."""
    signal = F.col("signal")
    cohort = (
        F.when(signal.isin("STRONG_BUY", "BUY"), F.lit("buy"))
        .when(signal.isin("SELL", "STRONG_SELL"), F.lit("sell"))
        .otherwise(F.lit("neutral"))
    )
    return momentum.groupBy(cohort.alias("cohort")).agg(
        F.count("*").alias("assets"), exact_mean("market_cap_rank", 2).alias("avg_rank")
    )


def signal_mix(momentum: DataFrame) -> DataFrame:
    return group_share(
        momentum, ["signal"], None, "pct_of_assets", 2, {"assets": F.count("*")}
    )


def sentiment_price_correlation(
    sentiment: DataFrame, daily: DataFrame, key: str = "id", days: int | None = None
) -> DataFrame:
    """Correlation of the daily index with each asset's close.

    ``days`` limits it to the last days of the price series.
    """
    prices = daily
    if days is not None:
        newest = daily.agg(F.max("day")).scalar()
        prices = daily.filter(F.col("day") > F.date_sub(newest, days))
    mood = F.col("value").cast("double").alias("mood")
    index = broadcast_if_small(sentiment.select(F.col("timestamp_date").alias("day"), mood))
    return (
        prices.join(index, "day")
        .groupBy(key)
        .agg(
            F.count("*").alias("days"),
            F.round(ticks.correlation("mood", "close"), 6).alias("correlation"),
        )
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells: list[Column] = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns
    ]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; exact by default, one small aggregation each."""
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values")) for c in columns]
        return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    counts = [
        df.groupBy(c).agg(F.lit(1)).agg(F.count(c).alias("values")).select(
            F.lit(c).alias("column_name"), "values"
        )
        for c in columns
    ]
    return reduce(DataFrame.unionByName, counts)
