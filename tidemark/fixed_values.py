"""Band edges, weights and labels the results depend on.

Fixed values: they define the published metrics. Every function that uses one
takes it as a keyword argument, with the value here as default.
"""

from __future__ import annotations

from tidemark.functions.bands import Bands

# --- staging -----------------------------------------------------------------
SIZE_TIERS = Bands(
    ">=",
    ((1e11, "mega_cap"), (1e10, "large_cap"), (1e9, "mid_cap"), (1e8, "small_cap")),
    "micro_cap",
)
SENTIMENT_ZONES = Bands(
    "<=",
    ((25, "extreme_fear"), (45, "fear"), (55, "neutral"), (75, "greed")),
    "extreme_greed",
)
SENTIMENT_LABELS = Bands(
    "<=",
    ((25, "Extreme Fear"), (45, "Fear"), (55, "Neutral"), (75, "Greed")),
    "Extreme Greed",
)

# --- volatility --------------------------------------------------------------
# column, divisor (days the change spans), weight
VOLATILITY_WEIGHTS = (
    ("abs_change_24h", 1.0, 0.3),
    ("intraday_spread_pct", 1.0, 0.3),
    ("abs_change_7d", 7.0, 0.2),
    ("abs_change_30d", 30.0, 0.2),
)
VOLATILITY_TIERS = Bands(
    ">", ((15, "ultra_volatile"), (8, "high"), (3, "moderate"), (1, "low")), "stable"
)
VOLUME_ACTIVITY = Bands(
    ">", ((0.5, "abnormally_high"), (0.2, "elevated"), (0.05, "normal")), "low"
)

# --- momentum ----------------------------------------------------------------
MOMENTUM_LADDERS = {
    "price_change_pct_24h": Bands(">", ((5, 20), (0, 10), (-5, 0)), -10),
    "price_change_pct_7d": Bands(">", ((15, 25), (0, 12), (-10, 0)), -12),
    "price_change_pct_30d": Bands(">", ((30, 25), (0, 12), (-20, 0)), -12),
    "volume_to_mcap_ratio": Bands(">", ((0.3, 15), (0.1, 8)), 0),
    "distance_from_ath_pct": Bands(">", ((-20, 15), (-50, 8)), 0),
}
# least score, sentiment the market must be below (None: any), signal
SIGNALS = (
    (60, 30, "STRONG_BUY"),
    (40, None, "BUY"),
    (-10, None, "NEUTRAL"),
    (-40, None, "SELL"),
)
SIGNAL_OTHERWISE = "STRONG_SELL"
CONFIDENCE = Bands(">", ((50, "HIGH"), (25, "MEDIUM")), "LOW")

# --- regime ------------------------------------------------------------------
BREADTH_WEIGHTS = {"24h": 0.2, "7d": 0.3, "30d": 0.3}
SENTIMENT_WEIGHT = 0.2
SENTIMENT_POINTS = Bands(">=", ((75, 20), (55, 10), (45, 0), (25, -10)), -20)
REGIMES = Bands(
    ">=", ((25, "STRONG_BULL"), (10, "BULL"), (-10, "NEUTRAL"), (-25, "BEAR")), "STRONG_BEAR"
)
NARRATIVES = {
    "STRONG_BULL": "Strong bullish momentum across the market. Majority of top coins are trending up with positive sentiment.",  # noqa: E501
    "BULL": "Moderately bullish conditions. Most indicators point upward but some caution warranted.",  # noqa: E501
    "NEUTRAL": "Mixed signals. Market is consolidating with no clear directional bias.",  # noqa: E501
    "BEAR": "Bearish pressure building. More coins are declining and sentiment is weakening.",  # noqa: E501
    "STRONG_BEAR": "Strong bearish conditions. Widespread selling pressure with extreme fear in the market.",  # noqa: E501
}

# --- cutoffs -----------------------------------------------------------------
HORIZONS = ("24h", "7d", "30d")
MAJOR_ASSETS = 50
RANKED_ASSETS = 100
TOP_K = 10
SHORT_MEAN = 7
LONG_MEAN = 14
TRENDS = ("improving", "deteriorating", "flat")
