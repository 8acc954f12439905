"""The contracts and business checks of the fourteen tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.functions.bands import Bands, mislabelled
from tidemark.functions.dates import ISO_DAY, at_least
from tidemark.operators import quality as q
from tidemark.operators.quality import Check, Contract

_CATEGORIES = [f"top_{way}_{h}" for h in v.HORIZONS for way in ("gainer", "loser")]
_SIGNALS = [signal for _, _, signal in v.SIGNALS] + [v.SIGNAL_OTHERWISE]
_TIER = {"price_tier": v.SIZE_TIERS.labels}

# Which columns may be empty and which ranges and labels they keep to.
CONTRACTS: dict[str, Contract] = {
    "raw_assets": Contract(
        optional=(
            "market_cap", "market_cap_rank", "fully_diluted_valuation", "total_volume",
            "high_24h", "low_24h", "price_change_24h", "price_change_percentage_24h",
            "market_cap_change_24h", "market_cap_change_percentage_24h", "circulating_supply",
            "total_supply", "max_supply", "ath", "ath_change_percentage", "atl",
            "atl_change_percentage", "price_change_percentage_1h_in_currency",
            "price_change_percentage_7d_in_currency", "price_change_percentage_14d_in_currency",
            "price_change_percentage_30d_in_currency",
        ),
        positive=(
            "current_price", "market_cap", "market_cap_rank", "fully_diluted_valuation",
            "high_24h", "low_24h", "circulating_supply", "total_supply", "max_supply", "ath",
            "atl",
        ),
        unique=("id",),
        least={"total_volume": 0},
        most={"market_cap_rank": 100},
    ),
    "raw_sentiment": Contract(
        positive=("value",),
        unique=("timestamp_date",),
        accepted={"value_classification": v.SENTIMENT_LABELS.labels},
        most={"value": 100},
    ),
    "raw_global": Contract(
        positive=(
            "total_market_cap_usd", "total_volume_usd", "btc_dominance", "eth_dominance",
            "active_cryptocurrencies", "markets",
        ),
        unique=("snapshot_date",),
        most={"btc_dominance": 100, "eth_dominance": 100},
    ),
    "raw_trending": Contract(
        optional=("market_cap_rank",),
        positive=("market_cap_rank",),
        unique=("coin_id",),
        least={"score": 0},
    ),
    "raw_categories": Contract(unique=("coin_id",)),
    "assets": Contract(
        optional=(
            "market_cap_rank", "circulating_supply", "total_supply", "max_supply", "ath",
            "volume_to_mcap_ratio", "supply_ratio_pct",
        ),
        positive=("current_price", "market_cap", "market_cap_rank", "ath"),
        unique=("id",),
        accepted=_TIER,
        least={"total_volume_24h": 0, "intraday_spread_pct": 0},
    ),
    "sentiment": Contract(
        optional=("ma_7d", "ma_14d", "daily_change", "ingested_at"),
        positive=("value", "ma_7d", "ma_14d"),
        unique=("timestamp_date",),
        accepted={
            "classification": v.SENTIMENT_LABELS.labels,
            "sentiment_zone": v.SENTIMENT_ZONES.labels,
        },
    ),
    "global_metrics": Contract(
        positive=(
            "total_market_cap_usd", "total_volume_usd", "btc_dominance", "eth_dominance",
            "altcoin_dominance", "active_cryptocurrencies", "markets", "global_volume_ratio",
        ),
        unique=("snapshot_date",),
    ),
    "market_dominance": Contract(
        positive=(
            "market_cap", "dominance_pct", "rank_by_mcap", "tier_dominance_pct", "coins_in_tier",
        ),
        unique=("id",),
        accepted=_TIER,
    ),
    "volatility_analysis": Contract(
        positive=("market_cap_rank", "current_price"),
        accepted={
            **_TIER,
            "volatility_tier": v.VOLATILITY_TIERS.labels,
            "volume_activity_level": v.VOLUME_ACTIVITY.labels,
        },
    ),
    "momentum_signals": Contract(
        optional=(
            "price_change_pct_24h", "price_change_pct_7d", "price_change_pct_30d",
            "volume_to_mcap_ratio", "distance_from_ath_pct",
        ),
        positive=("current_price", "market_cap_rank"),
        unique=("id",),
        accepted={
            **_TIER,
            "market_sentiment": v.SENTIMENT_LABELS.labels,
            "signal": _SIGNALS,
            "signal_confidence": v.CONFIDENCE.labels,
        },
        least={
            "market_cap_rank": 1, "volume_to_mcap_ratio": 0, "momentum_score": -60,
            "fear_greed_index": 0,
        },
        most={
            "market_cap_rank": 50, "volume_to_mcap_ratio": 10, "momentum_score": 110,
            "fear_greed_index": 100,
        },
    ),
    "top_performers": Contract(
        positive=("current_price", "market_cap_rank", "rank_in_category"),
        accepted={**_TIER, "timeframe": v.HORIZONS, "performance_category": _CATEGORIES},
    ),
    "zone_impact": Contract(
        positive=(
            "days_count", "avg_index_value", "min_value", "max_value", "pct_of_total_days",
            "current_value", "current_ma_7d",
        ),
        accepted={
            "sentiment_zone": v.SENTIMENT_ZONES.labels,
            "current_zone": v.SENTIMENT_ZONES.labels,
            "current_trend": v.TRENDS,
        },
        least={"std_dev": 0},
        most=dict.fromkeys(
            (
                "avg_index_value", "min_value", "max_value", "pct_of_total_days",
                "current_value", "current_ma_7d",
            ),
            100,
        ),
    ),
    "market_regime": Contract(
        accepted={"regime": v.REGIMES.labels, "sentiment_zone": v.SENTIMENT_ZONES.labels},
    ),
}


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def _range_off_zone(bands: Bands) -> Column:
    """A zone whose value range cannot come from its own band of whole numbers."""
    zone, low, high = F.col("sentiment_zone"), F.col("min_value"), F.col("max_value")
    edges = [edge for edge, _ in bands.steps]
    rules = [(zone == bands.labels[0]) & ((low > edges[0]) | (high > edges[0]))]
    for below, edge, label in zip(edges, edges[1:], bands.labels[1:]):
        rules.append((zone == label) & ((low > edge) | (high < below + 1)))
    rules.append((zone == bands.other) & (low < edges[-1] + 1))
    return reduce(Column.__or__, rules)


def business_checks(
    now: Column, anchor_id: str = "bitcoin", anchor_symbol: str = "btc"
) -> dict[str, list[Check]]:
    """The checks beyond single-column rules, per table. ``now`` is the as-of time."""
    c = F.col
    day = now.cast("date")
    value, cap = c("value"), c("market_cap")
    share_sum = c("btc_dominance") + c("eth_dominance")
    crossed = c("high_24h") < c("low_24h")
    ratio_off = _outside("volume_to_mcap_ratio", 0, 10)
    change, category = c("change_pct"), c("performance_category")
    strong = c("signal") == "STRONG_BUY"
    return {
        "raw_assets": [
            q.count("C01 at least 50 assets", ">=", 50),
            q.count("C02 anchor asset present", ">", 0, c("id") == anchor_id),
            q.violation("C03 no negative market cap", cap < 0),
            q.count("C04 ten largest present", ">=", 10, c("market_cap_rank") <= 10),
            q.count(
                "C05 updated within a day",
                ">",
                0,
                at_least(c("last_updated").try_cast("timestamp_ntz"), now, 1),
            ),
            q.violation(
                "C06 price in range", (c("current_price") > 1000000) | (c("current_price") <= 0)
            ),
            q.violation("C07 high not below low", crossed),
            q.violation(
                "C08 circulating within maximum",
                (c("circulating_supply") > c("max_supply")) & (c("max_supply") > 0),
            ),
        ],
        "raw_sentiment": [
            q.count("C09 at least 30 days", ">=", 30),
            q.violation("C10 value in range", _outside("value", 0, 100)),
            q.count("C11 updated within 3 days", ">", 0, at_least(c("timestamp_date"), day, 3)),
            q.violation("C12 no future day", c("timestamp_date") > day),
            q.ordered("C13 ingested in date order", "timestamp_date", "ingested_at"),
            q.violation(
                "C14 label fits value",
                mislabelled(c("value_classification"), value, v.SENTIMENT_LABELS),
            ),
            q.latest_count("C15 at least 80 days in the last run", "ingested_at", ">=", 80),
            q.groups(
                "C16 one row per day and run",
                ["timestamp_date", "ingested_at"],
                "=",
                0,
                having=c("_n") > 1,
            ),
        ],
        "raw_global": [
            q.violation(
                "C17 shares in range",
                _outside("btc_dominance", 0, 100) | _outside("eth_dominance", 0, 100),
            ),
            q.violation(
                "C18 volume within twice the cap",
                c("total_volume_usd") > c("total_market_cap_usd") * 2,
            ),
            q.violation("C19 two shares within 100", share_sum > 100),
            q.violation("C20 date text format", ~c("snapshot_date").rlike(ISO_DAY)),
            q.violation(
                "C21 ingested in the last 7 days",
                (c("ingested_at") > now) | (c("ingested_at") < now - F.expr("interval 7 days")),
            ),
        ],
        "raw_trending": [
            q.count("C22 at least 5 trending", ">=", 5),
            q.violation("C23 score in range", _outside("score", 0, 15)),
            q.latest_unique("C24 no asset twice per day", "snapshot_date", "coin_id"),
            q.count("C25 from today", ">", 0, c("snapshot_date").try_cast("date") == day),
            q.count("C26 some high score", ">", 0, c("score") >= 6),
        ],
        "raw_categories": [],
        "assets": [
            q.unique("C27 no asset twice", "id"),
            q.violation(
                "C28 largest tier above its edge",
                (c("price_tier") == v.SIZE_TIERS.labels[0]) & (cap < v.SIZE_TIERS.steps[0][0]),
            ),
            q.violation(
                "C29 derived columns filled",
                reduce(
                    Column.__or__,
                    [
                        c(x).isNull()
                        for x in (
                            "price_tier",
                            "volume_to_mcap_ratio",
                            "distance_from_ath_pct",
                            "intraday_spread_pct",
                        )
                    ],
                ),
            ),
            q.violation("C30 volume ratio in range", ratio_off),
            q.violation("C31 spread in range", _outside("intraday_spread_pct", 0, 1000)),
            q.violation("C32 high not below low", crossed),
            q.violation("C33 supply ratio in range", _outside("supply_ratio_pct", 0, 100)),
            q.violation(
                "C34 only valid prices", (c("current_price") <= 0) | c("current_price").isNull()
            ),
            q.violation("C35 ranked has a cap", c("market_cap_rank").isNotNull() & (cap <= 0)),
            q.count(
                "C36 anchor in the largest tier",
                ">",
                0,
                (c("id") == anchor_id) & (c("price_tier") == v.SIZE_TIERS.labels[0]),
            ),
        ],
        "sentiment": [
            q.violation(
                "C37 means in range", _outside("ma_7d", 0, 100) | _outside("ma_14d", 0, 100)
            ),
            q.violation(
                "C38 zone fits value", mislabelled(c("sentiment_zone"), value, v.SENTIMENT_ZONES)
            ),
            q.violation("C39 day change within 80", F.abs("daily_change") > 80),
            q.count("C40 enough days for the means", ">=", 14),
        ],
        "global_metrics": [
            q.violation("C41 two shares within 100", share_sum > 100),
            q.violation(
                "C42 shares in usual range",
                _outside("btc_dominance", 20, 80) | _outside("eth_dominance", 5, 30),
            ),
            q.violation("C43 volume ratio within 2", c("global_volume_ratio") > 2.0),
            q.violation("C44 some market", c("markets") == 0),
        ],
        "market_dominance": [
            q.total("C45 shares sum to 100", "dominance_pct", 100.0, 2.0),
            q.count(
                "C46 anchor share plausible",
                "=",
                1,
                (F.lower("symbol") == anchor_symbol) & c("dominance_pct").between(10, 95),
            ),
            q.violation("C47 tier share in range", _outside("tier_dominance_pct", 0, 100)),
            q.violation(
                "C48 largest tier share plausible",
                (c("price_tier") == v.SIZE_TIERS.labels[0])
                & _outside("tier_dominance_pct", 50, 95),
            ),
        ],
        "volatility_analysis": [
            q.violation("C49 score not negative", c("volatility_score") < 0),
            q.violation("C50 major assets only", c("market_cap_rank") > v.MAJOR_ASSETS),
            q.violation(
                "C51 tier fits score",
                mislabelled(c("volatility_tier"), c("volatility_score"), v.VOLATILITY_TIERS),
            ),
            q.distinct("C52 one analysis day", "analysis_date", "=", 1),
            q.violation("C53 spread in range", _outside("intraday_spread_pct", 0, 500)),
            q.violation("C54 volume ratio in range", ratio_off),
        ],
        "momentum_signals": [
            q.count("C55 at least 40 signals", ">=", 40),
            q.violation("C56 score in range", _outside("momentum_score", -60, 110)),
            q.violation(
                "C57 strong buy not of low confidence", strong & (c("signal_confidence") == "LOW")
            ),
            q.violation("C58 sentiment in range", _outside("fear_greed_index", 0, 100)),
            q.violation("C59 volume ratio in range", ratio_off),
            q.groups("C60 at least 2 signals in use", ["signal"], ">=", 2),
            q.violation(
                "C61 strong buy only in fear",
                strong & ~c("market_sentiment").isin(v.SENTIMENT_LABELS.labels[:2]),
            ),
            q.violation(
                "C62 large rise not scored negative",
                (c("price_change_pct_24h") > 50) & (c("momentum_score") < 0),
            ),
        ],
        "top_performers": [
            q.distinct("C63 gainers and losers present", "performance_category", ">=", 4),
            q.groups(
                "C64 ten per category",
                ["performance_category"],
                "=",
                0,
                having=c("_n") != v.TOP_K,
            ),
            q.violation("C65 ranked assets only", c("market_cap_rank") > v.RANKED_ASSETS),
            q.violation("C66 rank in range", _outside("rank_in_category", 1, v.TOP_K)),
            q.violation("C67 gainers rose", category.like("%gainer%") & (change <= 0)),
            q.violation("C68 losers fell", category.like("%loser%") & (change >= 0)),
            q.groups(
                "C69 first rank is the extreme",
                ["performance_category"],
                "=",
                0,
                having=c("_top") != c("_first"),
                aggregates={
                    "_top": F.max(F.abs(change)),
                    "_first": F.max(F.when(c("rank_in_category") == 1, F.abs(change))),
                },
            ),
            q.groups(
                "C70 no asset twice per category",
                ["performance_category", "id"],
                "=",
                0,
                having=c("_n") > 1,
            ),
        ],
        "zone_impact": [
            q.distinct("C71 at least 3 zones", "sentiment_zone", ">=", 3),
            q.total("C72 time shares sum to 100", "pct_of_total_days", 100.0, 0.1),
            q.violation("C73 value range fits zone", _range_off_zone(v.SENTIMENT_ZONES)),
        ],
        "market_regime": [q.count("C74 exactly one row", "=", 1)],
    }


def all_checks(tables: Mapping[str, DataFrame], now: Column) -> dict[str, list[Check]]:
    business = business_checks(now)
    return {
        name: CONTRACTS[name].checks(df.columns) + business[name] for name, df in tables.items()
    }


def run_checks(
    tables: Mapping[str, DataFrame], now: Column, kinds: tuple[str, ...] | None = None
) -> DataFrame:
    """Verdicts for the given tables, all checks or those of some kinds."""
    parts = []
    for name, checks in all_checks(tables, now).items():
        chosen = [x for x in checks if kinds is None or x.kind in kinds]
        if chosen:
            parts.append(q.dq_suite(name, tables[name], chosen))
    return reduce(DataFrame.unionByName, parts)
