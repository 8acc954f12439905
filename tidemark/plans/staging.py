"""Raw to staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.functions.bands import Bands, banded
from tidemark.functions.ratios import default_nulls, remainder_pct, safe_ratio
from tidemark.operators.ordering import SLICE_ROWS, series_columns

# raw name -> staged name, in output order; the second group may be NULL
_DEFAULTED = {
    "market_cap": "market_cap",
    "total_volume": "total_volume_24h",
    "high_24h": "high_24h",
    "low_24h": "low_24h",
    "price_change_percentage_24h": "price_change_pct_24h",
    "price_change_percentage_7d_in_currency": "price_change_pct_7d",
    "price_change_percentage_30d_in_currency": "price_change_pct_30d",
    "ath_change_percentage": "ath_drawdown_pct",
}
_KEPT = (
    "id",
    "symbol",
    "name",
    "current_price",
    "market_cap_rank",
    "circulating_supply",
    "total_supply",
    "max_supply",
    "ath",
    "last_updated",
    "ingested_at",
)


def valid_price(df: DataFrame, column: str = "current_price") -> DataFrame:
    """Rows with a positive, finite-comparable price.

    NaN counts as larger than any number here, so it is excluded by name.
    """
    price = F.col(column)
    return df.filter(price.isNotNull() & (price > 0) & ~F.isnan(price))


def volume_ratio(volume: str = "total_volume_24h", cap: str = "market_cap") -> Column:
    return safe_ratio(F.col(volume), F.col(cap), 4)


def supply_ratio(circulating: str = "circulating_supply", maximum: str = "max_supply") -> Column:
    """Percent of the maximum supply in circulation; NULL unless both are positive."""
    have = F.col(circulating)
    return safe_ratio(have, F.col(maximum), 2, 100.0, otherwise=None, guard=have > 0)


def intraday_spread(high: str = "high_24h", low: str = "low_24h") -> Column:
    return safe_ratio(F.col(high) - F.col(low), F.col(low), 2, 100.0)


def enrich_assets(raw: DataFrame, tiers: Bands = v.SIZE_TIERS) -> DataFrame:
    """Cleaned snapshot with size tier, liquidity, drawdown, supply and spread."""
    renamed = valid_price(raw).select(
        *_KEPT, *[F.col(source).alias(name) for source, name in _DEFAULTED.items()]
    )
    return default_nulls(renamed, _DEFAULTED.values()).withColumns(
        {
            "price_tier": banded(F.col("market_cap"), tiers),
            "volume_to_mcap_ratio": volume_ratio(),
            "distance_from_ath_pct": F.round("ath_drawdown_pct", 2),
            "supply_ratio_pct": supply_ratio(),
            "intraday_spread_pct": intraday_spread(),
        }
    )


def moving_mean(column: str, rows: int, digits: int = 1):
    """Trailing mean of ``rows`` rows; fewer at the start of the series."""
    return lambda w: F.round(F.avg(column).over(w.rowsBetween(1 - rows, 0)), digits)


def step_change(column: str):
    """Difference to the previous row; NULL on the first."""
    return lambda w: F.col(column) - F.lag(column).over(w)


def stage_sentiment(
    raw: DataFrame,
    short: int = v.SHORT_MEAN,
    long: int = v.LONG_MEAN,
    zones: Bands = v.SENTIMENT_ZONES,
    slice_size: int = SLICE_ROWS,
) -> DataFrame:
    """Daily index with trailing means, day change and zone."""
    columns = {
        f"ma_{short}d": moving_mean("value", short),
        f"ma_{long}d": moving_mean("value", long),
        "daily_change": step_change("value"),
    }
    order = [F.col(c) for c in ("timestamp_date", "ingested_at", "value", "value_classification")]
    smoothed = series_columns(raw, order, columns, max(short, long) - 1, slice_size)
    return smoothed.select(
        "timestamp_date",
        "value",
        F.col("value_classification").alias("classification"),
        *columns,
        banded(F.col("value"), zones).alias("sentiment_zone"),
        "ingested_at",
    )


def stage_global(raw: DataFrame) -> DataFrame:
    """Market totals with typed date, rounded shares, their remainder and liquidity."""
    first, second = F.col("btc_dominance"), F.col("eth_dominance")
    return raw.select(
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        "total_market_cap_usd",
        "total_volume_usd",
        F.round(first, 2).alias("btc_dominance"),
        F.round(second, 2).alias("eth_dominance"),
        remainder_pct(first, second).alias("altcoin_dominance"),
        "active_cryptocurrencies",
        "markets",
        F.round("market_cap_change_24h_pct", 2).alias("market_cap_change_24h_pct"),
        safe_ratio(F.col("total_volume_usd"), F.col("total_market_cap_usd"), 4).alias(
            "global_volume_ratio"
        ),
        "ingested_at",
    )
