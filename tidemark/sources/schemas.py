"""Column lists of the five raw tables."""

from __future__ import annotations

# The names and types the raw tables are published with.
ASSET_COLUMNS = {
    "id": "string",
    "symbol": "string",
    "name": "string",
    "current_price": "double",
    "market_cap": "bigint",
    "market_cap_rank": "bigint",
    "fully_diluted_valuation": "bigint",
    "total_volume": "double",
    "high_24h": "double",
    "low_24h": "double",
    "price_change_24h": "double",
    "price_change_percentage_24h": "double",
    "market_cap_change_24h": "double",
    "market_cap_change_percentage_24h": "double",
    "circulating_supply": "double",
    "total_supply": "double",
    "max_supply": "double",
    "ath": "double",
    "ath_change_percentage": "double",
    "ath_date": "string",
    "atl": "double",
    "atl_change_percentage": "double",
    "atl_date": "string",
    "price_change_percentage_1h_in_currency": "double",
    "price_change_percentage_7d_in_currency": "double",
    "price_change_percentage_14d_in_currency": "double",
    "price_change_percentage_30d_in_currency": "double",
    "last_updated": "string",
}
CATEGORY_SCHEMA = "coin_id string, category string, subcategory string"
SENTIMENT_DOCUMENT = (
    "data array<struct<value: string, value_classification: string, timestamp: string>>"
)
GLOBAL_DOCUMENT = (
    "data struct<total_market_cap: map<string, double>, total_volume: map<string, double>, "
    "market_cap_percentage: map<string, double>, active_cryptocurrencies: string, "
    "markets: string, market_cap_change_percentage_24h_usd: double>"
)
TRENDING_DOCUMENT = (
    "coins array<struct<item: struct<id: string, name: string, symbol: string, "
    "market_cap_rank: string, score: string>>>"
)
