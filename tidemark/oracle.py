"""The SQL twin of every query, for DuckDB on the same Parquet tables.

Written apart from the Spark code: plain windows, self-joins and one query per
check, which are right at test size and serve as the independent answer.
"""

from __future__ import annotations

import re


def half_up(expr: str, digits: int) -> str:
    """Round the decimal text of a double, ties away from zero, as Spark does."""
    return f"round(cast(cast({expr} as varchar) as decimal(38,18)), {digits})::double"


def _units(expr: str) -> str:
    """The exact sum of decimal texts, as a whole number of units of 1e-12."""
    total = f"sum(cast(cast({expr} as varchar) as decimal(38,12)))"
    return f"cast(replace(cast({total} as varchar), '.', '') as hugeint)"


def exact_sum(expr: str) -> str:
    return f"(sum(cast(cast({expr} as varchar) as decimal(38,12)))::double)"


def exact_mean(expr: str, digits: int) -> str:
    """The mean of decimal texts, rounded half-up once, whatever the order of adding."""
    units, n = _units(expr), f"count({expr})::hugeint"
    half = f"(2 * abs({units}) * {10**digits} + {n} * 1000000000000) // (2 * {n} * 1000000000000)"
    return f"(sign({units}) * ({half})::double / {float(10**digits)})"


# Fixed values, written out: the edges, points and labels of the published metrics.
_CASES = {
    "size_tier": "when {x} >= 100000000000 then 'mega_cap' when {x} >= 10000000000 then 'large_cap' "
    "when {x} >= 1000000000 then 'mid_cap' when {x} >= 100000000 then 'small_cap' else 'micro_cap'",
    "zone": "when {x} <= 25 then 'extreme_fear' when {x} <= 45 then 'fear' "
    "when {x} <= 55 then 'neutral' when {x} <= 75 then 'greed' else 'extreme_greed'",
    "label": "when {x} <= 25 then 'Extreme Fear' when {x} <= 45 then 'Fear' "
    "when {x} <= 55 then 'Neutral' when {x} <= 75 then 'Greed' else 'Extreme Greed'",
    "volatility": "when {x} > 15 then 'ultra_volatile' when {x} > 8 then 'high' "
    "when {x} > 3 then 'moderate' when {x} > 1 then 'low' else 'stable'",
    "activity": "when {x} > 0.5 then 'abnormally_high' when {x} > 0.2 then 'elevated' "
    "when {x} > 0.05 then 'normal' else 'low'",
    "confidence": "when {x} > 50 then 'HIGH' when {x} > 25 then 'MEDIUM' else 'LOW'",
    "sentiment_points": "when {x} >= 75 then 20 when {x} >= 55 then 10 when {x} >= 45 then 0 "
    "when {x} >= 25 then -10 else -20",
    "regime": "when {x} >= 25 then 'STRONG_BULL' when {x} >= 10 then 'BULL' "
    "when {x} >= -10 then 'NEUTRAL' when {x} >= -25 then 'BEAR' else 'STRONG_BEAR'",
    "narrative": """
        when {x} >= 25 then 'Strong bullish momentum across the market. Majority of top coins are trending up with positive sentiment.'
        when {x} >= 10 then 'Moderately bullish conditions. Most indicators point upward but some caution warranted.'
        when {x} >= -10 then 'Mixed signals. Market is consolidating with no clear directional bias.'
        when {x} >= -25 then 'Bearish pressure building. More coins are declining and sentiment is weakening.'
        else 'Strong bearish conditions. Widespread selling pressure with extreme fear in the market.'""",  # noqa: E501
    "price_change_pct_24h": "when {x} > 5 then 20 when {x} > 0 then 10 when {x} > -5 then 0 else -10",
    "price_change_pct_7d": "when {x} > 15 then 25 when {x} > 0 then 12 when {x} > -10 then 0 else -12",
    "price_change_pct_30d": "when {x} > 30 then 25 when {x} > 0 then 12 when {x} > -20 then 0 else -12",
    "volume_to_mcap_ratio": "when {x} > 0.3 then 15 when {x} > 0.1 then 8 else 0",
    "distance_from_ath_pct": "when {x} > -20 then 15 when {x} > -50 then 8 else 0",
}
_HORIZONS = ("24h", "7d", "30d")
_SCORED = (
    "price_change_pct_24h",
    "price_change_pct_7d",
    "price_change_pct_30d",
    "volume_to_mcap_ratio",
    "distance_from_ath_pct",
)


def case(name: str, expr: str) -> str:
    return f"(case {_CASES[name].format(x=expr)} end)"


def points(column: str) -> str:
    return case(column, column)


_SCORE = half_up("cast(" + " + ".join(points(c) for c in _SCORED) + " as double)", 1)
_VOLATILITY = """(abs_change_24h / 1.0::double * 0.3::double)
    + (intraday_spread_pct / 1.0::double * 0.3::double)
    + (abs_change_7d / 7.0::double * 0.2::double)
    + (abs_change_30d / 30.0::double * 0.2::double)"""
_SIGNAL = """case when momentum_score >= 60 and fear_greed_index < 30 then 'STRONG_BUY'
    when momentum_score >= 40 then 'BUY'
    when momentum_score >= -10 then 'NEUTRAL'
    when momentum_score >= -40 then 'SELL'
    else 'STRONG_SELL' end"""
_ISO = "'%Y-%m-%dT%H:%M:%S'"
_HORIZON = {
    "1h": "1 hour",
    "24h": "1 day",
    "7d": "7 day",
    "14d": "14 day",
    "30d": "21 day",
}


def _past(spans: dict[str, str]) -> str:
    return ", ".join(
        f"max_by(value, row(ts, value)) filter (where ts <= (select newest from now_at) - interval {span}) as p_{h}"
        for h, span in spans.items()
    )


def _change(new: str, old: str) -> str:
    return f"(({new} - {old}) / nullif({old}, 0) * 100.0::double)"


def _share(part: str, whole: str) -> str:
    return f"(({part})::double * 100.0::double / nullif(({whole})::double, 0))"


def _trend(fast: str = "ma_7d", slow: str = "ma_14d") -> str:
    return (
        f"case when {fast} > {slow} then 'improving' "
        f"when {fast} < {slow} then 'deteriorating' else 'flat' end"
    )


_ASSET_COLUMNS = (
    "id, symbol, name, current_price, market_cap_rank, circulating_supply, total_supply, "
    "max_supply, ath, last_updated, ingested_at"
)

# Named tables; a query gets those it mentions, in this order.
TABLES: dict[str, str] = {
    "now_at": "select max(ts) as newest from events",
    "per_user": f"""
        select user_id as key,
            max_by(value, row(ts, value)) as cur,
            sum(cast(round(value * 100) as bigint)) as cents,
            sum(cast(round(value * 100) as bigint))
                filter (where ts > (select newest from now_at) - interval 1 day) as recent,
            max(value) filter (where ts > (select newest from now_at) - interval 1 day) as high,
            min(value) filter (where ts > (select newest from now_at) - interval 1 day) as low,
            max(value) as ath, min(value) as atl, max(ts) as last_at, count(*) as n,
            min(ts) as first_at,
            {_past(_HORIZON)}
        from events group by user_id""",
    "sized": """
        select *, cents::double * power(10.0::double, (key % 6 + 1)::double) as cap from per_user""",
    "raw_assets": f"""
        select cast(key as varchar) as id,
            's' || key as symbol,
            'Asset ' || key as name,
            case when last_at > (select newest from now_at) - interval 2 day then cur end
                as current_price,
            cap as market_cap,
            case when recent is not null
                then cast(row_number() over (order by cap desc, key) as bigint) end
                as market_cap_rank,
            cap * 2 as fully_diluted_valuation,
            recent::double * power(10.0::double, (key % 6 + 1)::double) as total_volume,
            high as high_24h, low as low_24h,
            cur - p_24h as price_change_24h,
            {_change("cur", "p_24h")} as price_change_percentage_24h,
            cap * {_change("cur", "p_24h")} / 100.0::double as market_cap_change_24h,
            {_change("cur", "p_24h")} as market_cap_change_percentage_24h,
            n::double as circulating_supply,
            n::double * 2 as total_supply,
            case when key % 5 <> 0 then (n + key % 40)::double end as max_supply,
            ath,
            {_change("cur", "ath")} as ath_change_percentage,
            strftime(first_at, {_ISO}) as ath_date,
            atl,
            {_change("cur", "atl")} as atl_change_percentage,
            strftime(first_at, {_ISO}) as atl_date,
            {_change("cur", "p_1h")} as price_change_percentage_1h_in_currency,
            {_change("cur", "p_7d")} as price_change_percentage_7d_in_currency,
            {_change("cur", "p_14d")} as price_change_percentage_14d_in_currency,
            {_change("cur", "p_30d")} as price_change_percentage_30d_in_currency,
            strftime(last_at, {_ISO}) as last_updated,
            (select newest from now_at) as ingested_at
        from sized""",
    "day_orders": """
        select *, cast(o_orderdate as date) as day,
            cast(round(o_totalprice * 100) as bigint) as cents
        from orders""",
    "day_value": """
        select day, cast(sum(cents) % 101 as bigint) as value from day_orders group by day""",
    "raw_sentiment": f"""
        select value, {case("label", "value")} as value_classification,
            day as timestamp_date, (select newest from now_at) as ingested_at
        from day_value""",
    "restated_sentiment": f"""
        select * replace ({case("label", "value")} as value_classification) from (
            select * replace (case when timestamp_date between '1995-03-10' and '1995-03-12'
                then 100 - value else value end as value) from raw_sentiment)""",
    "raw_global": f"""
        select cap as total_market_cap_usd, vol as total_volume_usd,
            {_share("first_part", "cap")} as btc_dominance,
            {_share("second_part", "cap")} as eth_dominance,
            buyers as active_cryptocurrencies, n as markets,
            coalesce(up / nullif(down, 0), 0::double) as market_cap_change_24h_pct,
            strftime(day, '%Y-%m-%d') as snapshot_date,
            (select newest from now_at) as ingested_at
        from (
            select day, sum(cents)::double as cap,
                coalesce(sum(cents) filter (where o_orderstatus = 'F'), 0)::double as vol,
                coalesce(sum(cents) filter (where o_orderpriority = '1-URGENT'), 0)::double
                    as first_part,
                coalesce(sum(cents) filter (where o_orderpriority = '2-HIGH'), 0)::double
                    as second_part,
                coalesce(sum(cents) filter (where o_orderpriority = '4-NOT SPECIFIED'), 0)::double
                    as up,
                coalesce(sum(cents) filter (where o_orderpriority = '5-LOW'), 0)::double as down,
                count(distinct o_custkey) as buyers, count(*) as n
            from day_orders group by day)""",
    "raw_trending": """
        select cast(user_id as varchar) as coin_id, 'Asset ' || user_id as name,
            's' || user_id as symbol,
            case when score > 1 then user_id + 1 end as market_cap_rank,
            score, strftime((select newest from now_at), '%Y-%m-%d') as snapshot_date,
            (select newest from now_at) as ingested_at
        from (
            select user_id, count(*) as score from events
            where ts > (select newest from now_at) - interval 1 day group by user_id)""",
    "raw_categories": """
        select cast(c_custkey as varchar) as coin_id, c_mktsegment as category,
            n_name as subcategory
        from customer join nation on c_nationkey = n_nationkey""",
    "cleaned": f"""
        select {_ASSET_COLUMNS},
            ifnull(market_cap, 0) as market_cap,
            ifnull(total_volume, 0) as total_volume_24h,
            ifnull(high_24h, 0) as high_24h,
            ifnull(low_24h, 0) as low_24h,
            ifnull(price_change_percentage_24h, 0) as price_change_pct_24h,
            ifnull(price_change_percentage_7d_in_currency, 0) as price_change_pct_7d,
            ifnull(price_change_percentage_30d_in_currency, 0) as price_change_pct_30d,
            ifnull(ath_change_percentage, 0) as ath_drawdown_pct
        from raw_assets where current_price > 0""",
    "assets": f"""
        select *,
            {case("size_tier", "market_cap")} as price_tier,
            ifnull({half_up("total_volume_24h / nullif(market_cap, 0)", 4)}, 0)
                as volume_to_mcap_ratio,
            {half_up("ath_drawdown_pct", 2)} as distance_from_ath_pct,
            {half_up("circulating_supply / nullif(max_supply, 0) * 100.0::double", 2)}
                as supply_ratio_pct,
            ifnull({half_up("(high_24h - low_24h) / nullif(low_24h, 0) * 100.0::double", 2)}, 0)
                as intraday_spread_pct
        from cleaned""",
    "sentiment": f"""
        select timestamp_date, value, value_classification as classification,
            {half_up("avg(value) over last_7", 1)} as ma_7d,
            {half_up("avg(value) over last_14", 1)} as ma_14d,
            value - lag(value) over (order by timestamp_date) as daily_change,
            {case("zone", "value")} as sentiment_zone,
            ingested_at
        from raw_sentiment
        window last_7 as (order by timestamp_date rows 6 preceding),
            last_14 as (order by timestamp_date rows 13 preceding)""",
    "global_metrics": f"""
        select cast(snapshot_date as date) as snapshot_date, total_market_cap_usd,
            total_volume_usd,
            {half_up("btc_dominance", 2)} as btc_dominance,
            {half_up("eth_dominance", 2)} as eth_dominance,
            {half_up("100.0::double - btc_dominance - eth_dominance", 2)} as altcoin_dominance,
            active_cryptocurrencies, markets,
            {half_up("market_cap_change_24h_pct", 2)} as market_cap_change_24h_pct,
            ifnull({half_up("total_volume_usd / nullif(total_market_cap_usd, 0)", 4)}, 0)
                as global_volume_ratio,
            ingested_at
        from raw_global""",
    "tiers": f"""
        select price_tier, count(*) as coin_count, {exact_sum("market_cap")} as tier_market_cap,
            {half_up(_share(exact_sum("market_cap"), f"(select {exact_sum('market_cap')} from assets)"), 2)}
                as tier_dominance_pct
        from assets group by price_tier""",
    "market_dominance": f"""
        select (select newest from now_at)::date as snapshot_date, a.id, a.name, a.symbol,
            a.market_cap,
            {half_up(_share("a.market_cap", f"(select {exact_sum('market_cap')} from assets)"), 4)}
                as dominance_pct,
            1 + (select count(*) from assets b where b.market_cap > a.market_cap) as rank_by_mcap,
            a.price_tier, t.tier_dominance_pct, t.coin_count as coins_in_tier
        from assets a left join tiers t using (price_tier)""",
    "scored": f"""
        select *, {_VOLATILITY} as raw_score
        from (
            select *, abs(price_change_pct_24h) as abs_change_24h,
                abs(price_change_pct_7d) as abs_change_7d,
                abs(price_change_pct_30d) as abs_change_30d
            from assets)""",
    "volatility_analysis": f"""
        select (select newest from now_at)::date as analysis_date, id, name, symbol, market_cap_rank,
            price_tier, current_price, intraday_spread_pct, abs_change_24h, abs_change_7d,
            abs_change_30d, {half_up("raw_score", 2)} as volatility_score,
            {case("volatility", "raw_score")} as volatility_tier,
            distance_from_ath_pct, volume_to_mcap_ratio,
            {case("activity", "volume_to_mcap_ratio")} as volume_activity_level
        from scored where market_cap_rank <= 50""",
    "today": f"""
        select *, {_trend()} as sentiment_trend from sentiment
        order by timestamp_date desc limit 1""",
    "momentum": f"""
        select *, {_SCORE} as momentum_score,
            (select value from today) as fear_greed_index,
            (select classification from today) as market_sentiment
        from assets""",
    "momentum_signals": f"""
        select (select newest from now_at)::date as analysis_date, id, name, symbol, current_price,
            market_cap_rank, price_tier, price_change_pct_24h, price_change_pct_7d,
            price_change_pct_30d, volume_to_mcap_ratio, distance_from_ath_pct, momentum_score,
            fear_greed_index, market_sentiment, {_SIGNAL} as signal,
            {case("confidence", "abs(momentum_score)")} as signal_confidence
        from momentum where market_cap_rank <= 50""",
    "moves": " union all ".join(
        f"select id, name, symbol, current_price, market_cap_rank, price_tier, "
        f"'{h}' as timeframe, price_change_pct_{h} as change "
        f"from assets where market_cap_rank <= 100"
        for h in _HORIZONS
    ),
    "top_performers": f"""
        select (select newest from now_at)::date as analysis_date, id, name, symbol, current_price,
            market_cap_rank, price_tier, timeframe, {half_up("change", 2)} as change_pct,
            'top_' || way || '_' || timeframe as performance_category,
            cast(place as bigint) as rank_in_category
        from (
            select *, 'gainer' as way, row_number()
                over (partition by timeframe order by change desc, id) as place from moves
            union all
            select *, 'loser' as way, row_number()
                over (partition by timeframe order by change, id) as place from moves)
        where place <= 10""",
    "zone_stats": f"""
        select sentiment_zone, count(*) as days_count, {half_up("avg(value)", 1)} as avg_index_value,
            min(value) as min_value, max(value) as max_value,
            ifnull({half_up("stddev_samp(value)", 1)}, 0) as std_dev,
            {half_up(_share("count(*)", "(select count(*) from sentiment)"), 1)}
                as pct_of_total_days
        from sentiment group by sentiment_zone""",
    "zone_impact": """
        select (select newest from now_at)::date as analysis_date, z.*, t.value as current_value,
            t.sentiment_zone as current_zone, t.ma_7d as current_ma_7d,
            t.sentiment_trend as current_trend
        from zone_stats z, today t""",
    "breadth": """
        select count(*) as total_coins, """
    + ", ".join(
        f"cast(sum(case when price_change_pct_{h} {op} 0 then 1 else 0 end) as bigint) as {way}_{h}"
        for h in _HORIZONS
        for way, op in (("up", ">"), ("down", "<"))
    )
    + ", "
    + ", ".join(
        f"{exact_mean(f'price_change_pct_{h}', 2)} as avg_change_{h}" for h in _HORIZONS
    )
    + f", {exact_mean('volume_to_mcap_ratio', 4)} as avg_volume_ratio"
    + " from assets where market_cap_rank <= 50",
    "state": f"""
        select b.*, t.value as fg, t.ma_7d, t.sentiment_zone, g.market_cap_change_24h_pct,
            g.btc_dominance, g.altcoin_dominance,
            {half_up(" + ".join(
                f"({_share(f'up_{h}', 'total_coins')} - 50.0::double) * {w}::double"
                for h, w in (("24h", 0.2), ("7d", 0.3), ("30d", 0.3))
            ) + f" + {case('sentiment_points', 't.value')} * 0.2::double", 1)}
                as regime_score
        from breadth b, today t,
            (select * from global_metrics order by snapshot_date desc limit 1) g""",
    "market_regime": f"""
        select (select newest from now_at)::date as analysis_date,
            {case("regime", "regime_score")} as regime, regime_score,
            total_coins as coins_analyzed, """
    + ", ".join(
        f"{half_up(_share(f'up_{h}', 'total_coins'), 1)} as pct_up_{h}" for h in _HORIZONS
    )
    + f""", avg_change_24h, avg_change_7d, avg_change_30d, fg as fear_greed_current,
            ma_7d as fear_greed_ma_7d, sentiment_zone, market_cap_change_24h_pct, btc_dominance,
            altcoin_dominance, avg_volume_ratio,
            {case("narrative", "regime_score")} as regime_narrative
        from state""",
    "leaders": """
        select id, row_number() over (order by market_cap_rank, id) as place
        from raw_assets where market_cap_rank is not null""",
    "daily": f"""
        select cast(user_id as varchar) as id, cast(ts as date) as day,
            max_by(value, row(ts, value)) as close, {exact_sum("value")} as volume
        from events group by all""",
    "moved": """
        select *, close - lag(close) over s as move,
            (close - lag(close) over s) / nullif(lag(close) over s, 0) * 100.0::double as change_pct
        from daily window s as (partition by id order by day)""",
    "trends": f"select *, {_trend()} as sentiment_trend from sentiment",
}


def sql(body: str) -> str:
    """Put the tables a query needs, directly or through others, in front of it."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(TABLES[name])
    parts = [f"{name} as ({TABLES[name]})" for name in TABLES if name in needed]
    return f"with {', '.join(parts)} {body}" if parts else body


# --- quality -----------------------------------------------------------------
# The contracts, read off as table: (may be empty, positive, unique, accepted, min, max).
# Written out here so that a slip in the Spark contracts shows up.
_T = ["mega_cap", "large_cap", "mid_cap", "small_cap", "micro_cap"]
_SIGNAL_LABELS = ["STRONG_BUY", "BUY", "NEUTRAL", "SELL", "STRONG_SELL"]
_CATEGORY_LABELS = [f"top_{w}_{h}" for w in ("gainer", "loser") for h in ("24h", "7d", "30d")]
_ZONES = ["extreme_fear", "fear", "neutral", "greed", "extreme_greed"]
_LABELS = ["Extreme Fear", "Fear", "Neutral", "Greed", "Extreme Greed"]

REQUIRED = {
    "raw_assets": "id symbol current_price ingested_at name ath_date atl_date last_updated",
    "raw_sentiment": "value value_classification timestamp_date ingested_at",
    "raw_global": "total_market_cap_usd btc_dominance eth_dominance snapshot_date "
    "total_volume_usd active_cryptocurrencies markets market_cap_change_24h_pct ingested_at",
    "raw_trending": "coin_id name symbol score snapshot_date ingested_at",
    "raw_categories": "coin_id category subcategory",
    "assets": "id current_price price_tier symbol name market_cap total_volume_24h high_24h "
    "low_24h price_change_pct_24h price_change_pct_7d price_change_pct_30d ath_drawdown_pct "
    "last_updated ingested_at distance_from_ath_pct intraday_spread_pct",
    "sentiment": "timestamp_date value classification sentiment_zone",
    "global_metrics": "snapshot_date total_market_cap_usd btc_dominance altcoin_dominance "
    "total_volume_usd eth_dominance active_cryptocurrencies markets market_cap_change_24h_pct "
    "global_volume_ratio ingested_at",
    "market_dominance": "snapshot_date id name symbol market_cap dominance_pct rank_by_mcap "
    "price_tier tier_dominance_pct coins_in_tier",
    "volatility_analysis": "analysis_date id name symbol market_cap_rank price_tier "
    "current_price intraday_spread_pct abs_change_24h abs_change_7d abs_change_30d "
    "volatility_score volatility_tier distance_from_ath_pct volume_to_mcap_ratio "
    "volume_activity_level",
    "momentum_signals": "analysis_date id name symbol current_price market_cap_rank price_tier "
    "momentum_score fear_greed_index market_sentiment signal signal_confidence",
    "top_performers": "analysis_date id name symbol current_price market_cap_rank price_tier "
    "timeframe change_pct performance_category rank_in_category",
    "zone_impact": "analysis_date sentiment_zone days_count avg_index_value min_value max_value "
    "std_dev pct_of_total_days current_value current_zone current_ma_7d current_trend",
    "market_regime": "analysis_date regime regime_score coins_analyzed pct_up_24h pct_up_7d "
    "pct_up_30d avg_change_24h avg_change_7d avg_change_30d fear_greed_current fear_greed_ma_7d "
    "sentiment_zone market_cap_change_24h_pct btc_dominance altcoin_dominance avg_volume_ratio "
    "regime_narrative",
}
POSITIVE = {
    "raw_assets": "current_price market_cap market_cap_rank fully_diluted_valuation high_24h "
    "low_24h circulating_supply total_supply max_supply ath atl",
    "raw_sentiment": "value",
    "raw_global": "total_market_cap_usd btc_dominance eth_dominance total_volume_usd "
    "active_cryptocurrencies markets",
    "raw_trending": "market_cap_rank",
    "assets": "current_price market_cap market_cap_rank ath",
    "sentiment": "value ma_7d ma_14d",
    "global_metrics": "total_market_cap_usd btc_dominance altcoin_dominance total_volume_usd "
    "eth_dominance active_cryptocurrencies markets global_volume_ratio",
    "market_dominance": "market_cap dominance_pct rank_by_mcap tier_dominance_pct coins_in_tier",
    "volatility_analysis": "market_cap_rank current_price",
    "momentum_signals": "current_price market_cap_rank",
    "top_performers": "current_price market_cap_rank rank_in_category",
    "zone_impact": "days_count avg_index_value min_value max_value pct_of_total_days "
    "current_value current_ma_7d",
}
UNIQUE = {
    "raw_assets": "id",
    "raw_sentiment": "timestamp_date",
    "raw_global": "snapshot_date",
    "raw_trending": "coin_id",
    "raw_categories": "coin_id",
    "assets": "id",
    "sentiment": "timestamp_date",
    "global_metrics": "snapshot_date",
    "market_dominance": "id",
    "momentum_signals": "id",
}
ACCEPTED: dict[str, dict[str, list[str]]] = {
    "raw_sentiment": {"value_classification": _LABELS},
    "assets": {"price_tier": _T},
    "sentiment": {"classification": _LABELS, "sentiment_zone": _ZONES},
    "market_dominance": {"price_tier": _T},
    "volatility_analysis": {
        "price_tier": _T,
        "volatility_tier": ["stable", "low", "moderate", "high", "ultra_volatile"],
        "volume_activity_level": ["low", "normal", "elevated", "abnormally_high"],
    },
    "momentum_signals": {
        "price_tier": _T,
        "market_sentiment": _LABELS,
        "signal": _SIGNAL_LABELS,
        "signal_confidence": ["LOW", "MEDIUM", "HIGH"],
    },
    "top_performers": {
        "price_tier": _T,
        "timeframe": ["24h", "7d", "30d"],
        "performance_category": _CATEGORY_LABELS,
    },
    "zone_impact": {
        "sentiment_zone": _ZONES,
        "current_zone": _ZONES,
        "current_trend": ["improving", "deteriorating", "flat"],
    },
    "market_regime": {
        "regime": ["STRONG_BULL", "BULL", "NEUTRAL", "BEAR", "STRONG_BEAR"],
        "sentiment_zone": _ZONES,
    },
}
LEAST = {
    "raw_assets": {"total_volume": 0},
    "raw_trending": {"score": 0},
    "assets": {"total_volume_24h": 0, "intraday_spread_pct": 0},
    "momentum_signals": {
        "market_cap_rank": 1,
        "volume_to_mcap_ratio": 0,
        "momentum_score": -60,
        "fear_greed_index": 0,
    },
    "zone_impact": {"std_dev": 0},
}
MOST = {
    "raw_assets": {"market_cap_rank": 100},
    "raw_sentiment": {"value": 100},
    "raw_global": {"btc_dominance": 100, "eth_dominance": 100},
    "momentum_signals": {
        "market_cap_rank": 50,
        "volume_to_mcap_ratio": 10,
        "momentum_score": 110,
        "fear_greed_index": 100,
    },
    "zone_impact": {
        "avg_index_value": 100,
        "min_value": 100,
        "max_value": 100,
        "pct_of_total_days": 100,
        "current_value": 100,
        "current_ma_7d": 100,
    },
}


def _broken(table: str, name: str, kind: str, condition: str) -> str:
    return (
        f"select '{table}' as table_name, '{name}' as check_name, '{kind}' as kind, "
        f"count(*)::double as observed, count(*) = 0 as passed from {table} where {condition}"
    )


def _column_checks() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {k: [] for k in (
        "not_null", "positive", "accepted_values", "min", "max", "unique"
    )}

    def add(table: str, column: str, kind: str, condition: str) -> None:
        out[kind].append(_broken(table, f"{column} {kind}", kind, condition))

    for table, columns in REQUIRED.items():
        for c in columns.split():
            add(table, c, "not_null", f"{c} is null")
    for table, columns in POSITIVE.items():
        for c in columns.split():
            add(table, c, "positive", f"{c} <= 0")
    for table, allowed in ACCEPTED.items():
        for c, values in allowed.items():
            names = ", ".join(f"'{x}'" for x in values)
            add(table, c, "accepted_values", f"{c} not in ({names})")
    for table, bounds in LEAST.items():
        for c, bound in bounds.items():
            add(table, c, "min", f"{c} < {bound}")
    for table, bounds in MOST.items():
        for c, bound in bounds.items():
            add(table, c, "max", f"{c} > {bound}")
    for table, c in UNIQUE.items():
        out["unique"].append(
            f"select '{table}' as table_name, '{c} unique' as check_name, 'unique' as kind, "
            f"(count({c}) - count(distinct {c}))::double as observed, "
            f"count({c}) = count(distinct {c}) as passed from {table}"
        )
    return out


def _zone_mismatch(label: str, value: str, names: list[str], upper: tuple[int, ...]) -> str:
    """Rows whose value lies outside the interval their label stands for."""
    rules = [f"({label} = '{names[0]}' and {value} > {upper[0]})"]
    for low, high, name in zip(upper, upper[1:], names[1:]):
        rules.append(f"({label} = '{name}' and not ({value} > {low} and {value} <= {high}))")
    rules.append(f"({label} = '{names[-1]}' and {value} <= {upper[-1]})")
    return " or ".join(rules)


_EDGES = (25, 45, 55, 75)
_NOW = "(select newest from now_at)"
# check, table, broken rows
_VIOLATIONS = (
    ("C03 no negative market cap", "raw_assets", "market_cap < 0"),
    ("C06 price in range", "raw_assets", "not (current_price > 0 and current_price <= 1000000)"),
    ("C07 high not below low", "raw_assets", "low_24h > high_24h"),
    (
        "C08 circulating within maximum",
        "raw_assets",
        "max_supply > 0 and max_supply < circulating_supply",
    ),
    ("C10 value in range", "raw_sentiment", "value not between 0 and 100"),
    ("C12 no future day", "raw_sentiment", f"timestamp_date > {_NOW}::date"),
    (
        "C14 label fits value",
        "raw_sentiment",
        _zone_mismatch("value_classification", "value", _LABELS, _EDGES),
    ),
    (
        "C17 shares in range",
        "raw_global",
        "btc_dominance not between 0 and 100 or eth_dominance not between 0 and 100",
    ),
    (
        "C18 volume within twice the cap",
        "raw_global",
        "total_volume_usd / 2 > total_market_cap_usd",
    ),
    ("C19 two shares within 100", "raw_global", "btc_dominance + eth_dominance > 100"),
    (
        "C20 date text format",
        "raw_global",
        "not regexp_full_match(snapshot_date, '\\d{4}-\\d{2}-\\d{2}')",
    ),
    (
        "C21 ingested in the last 7 days",
        "raw_global",
        f"ingested_at not between {_NOW} - interval 7 day and {_NOW}",
    ),
    ("C23 score in range", "raw_trending", "score not between 0 and 15"),
    (
        "C28 largest tier above its edge",
        "assets",
        "price_tier = 'mega_cap' and market_cap < 100000000000",
    ),
    (
        "C29 derived columns filled",
        "assets",
        "price_tier is null or volume_to_mcap_ratio is null or distance_from_ath_pct is null "
        "or intraday_spread_pct is null",
    ),
    ("C30 volume ratio in range", "assets", "volume_to_mcap_ratio not between 0 and 10"),
    ("C31 spread in range", "assets", "intraday_spread_pct not between 0 and 1000"),
    ("C32 high not below low", "assets", "low_24h > high_24h"),
    ("C33 supply ratio in range", "assets", "supply_ratio_pct not between 0 and 100"),
    ("C34 only valid prices", "assets", "coalesce(current_price, 0) <= 0"),
    ("C35 ranked has a cap", "assets", "market_cap <= 0 and market_cap_rank is not null"),
    (
        "C37 means in range",
        "sentiment",
        "ma_7d not between 0 and 100 or ma_14d not between 0 and 100",
    ),
    (
        "C38 zone fits value",
        "sentiment",
        _zone_mismatch("sentiment_zone", "value", _ZONES, _EDGES),
    ),
    ("C39 day change within 80", "sentiment", "daily_change not between -80 and 80"),
    ("C41 two shares within 100", "global_metrics", "btc_dominance + eth_dominance > 100"),
    (
        "C42 shares in usual range",
        "global_metrics",
        "btc_dominance not between 20 and 80 or eth_dominance not between 5 and 30",
    ),
    ("C43 volume ratio within 2", "global_metrics", "global_volume_ratio > 2"),
    ("C44 some market", "global_metrics", "markets = 0"),
    (
        "C47 tier share in range",
        "market_dominance",
        "tier_dominance_pct not between 0 and 100",
    ),
    (
        "C48 largest tier share plausible",
        "market_dominance",
        "price_tier = 'mega_cap' and tier_dominance_pct not between 50 and 95",
    ),
    ("C49 score not negative", "volatility_analysis", "volatility_score < 0"),
    ("C50 major assets only", "volatility_analysis", "market_cap_rank > 50"),
    (
        "C51 tier fits score",
        "volatility_analysis",
        _zone_mismatch(
            "volatility_tier",
            "volatility_score",
            ["stable", "low", "moderate", "high", "ultra_volatile"],
            (1, 3, 8, 15),
        ),
    ),
    ("C53 spread in range", "volatility_analysis", "intraday_spread_pct not between 0 and 500"),
    (
        "C54 volume ratio in range",
        "volatility_analysis",
        "volume_to_mcap_ratio not between 0 and 10",
    ),
    ("C56 score in range", "momentum_signals", "momentum_score not between -60 and 110"),
    (
        "C57 strong buy not of low confidence",
        "momentum_signals",
        "signal = 'STRONG_BUY' and signal_confidence = 'LOW'",
    ),
    ("C58 sentiment in range", "momentum_signals", "fear_greed_index not between 0 and 100"),
    (
        "C59 volume ratio in range",
        "momentum_signals",
        "volume_to_mcap_ratio not between 0 and 10",
    ),
    (
        "C61 strong buy only in fear",
        "momentum_signals",
        "signal = 'STRONG_BUY' and market_sentiment not in ('Extreme Fear', 'Fear')",
    ),
    (
        "C62 large rise not scored negative",
        "momentum_signals",
        "price_change_pct_24h > 50 and momentum_score < 0",
    ),
    ("C65 ranked assets only", "top_performers", "market_cap_rank > 100"),
    ("C66 rank in range", "top_performers", "rank_in_category not between 1 and 10"),
    (
        "C67 gainers rose",
        "top_performers",
        "contains(performance_category, 'gainer') and change_pct <= 0",
    ),
    (
        "C68 losers fell",
        "top_performers",
        "contains(performance_category, 'loser') and change_pct >= 0",
    ),
    (
        "C73 value range fits zone",
        "zone_impact",
        "(sentiment_zone = 'extreme_fear' and greatest(min_value, max_value) > 25) "
        "or (sentiment_zone = 'fear' and (min_value > 45 or max_value < 26)) "
        "or (sentiment_zone = 'neutral' and (min_value > 55 or max_value < 46)) "
        "or (sentiment_zone = 'greed' and (min_value > 75 or max_value < 56)) "
        "or (sentiment_zone = 'extreme_greed' and min_value < 76)",
    ),
)
# check, kind, table, observed, what it must satisfy
_MEASURES = (
    ("C01 at least 50 assets", "count", "raw_assets", "count(*)", ">= 50"),
    (
        "C02 anchor asset present",
        "count",
        "raw_assets",
        "count(*) filter (where id = 'bitcoin')",
        "> 0",
    ),
    (
        "C04 ten largest present",
        "count",
        "raw_assets",
        "count(*) filter (where market_cap_rank <= 10)",
        ">= 10",
    ),
    (
        "C05 updated within a day",
        "count",
        "raw_assets",
        f"count(*) filter (where last_updated::timestamp >= {_NOW} - interval 1 day)",
        "> 0",
    ),
    ("C09 at least 30 days", "count", "raw_sentiment", "count(*)", ">= 30"),
    (
        "C11 updated within 3 days",
        "count",
        "raw_sentiment",
        f"count(*) filter (where timestamp_date >= {_NOW}::date - interval 3 day)",
        "> 0",
    ),
    (
        "C13 ingested in date order",
        "order",
        "raw_sentiment b",
        "count(distinct b.timestamp_date) filter (where exists (select 1 from raw_sentiment a "
        "where a.timestamp_date < b.timestamp_date and a.ingested_at > b.ingested_at))",
        "= 0",
    ),
    (
        "C15 at least 80 days in the last run",
        "latest",
        "raw_sentiment",
        "count(*) filter (where ingested_at = (select max(ingested_at) from raw_sentiment))",
        ">= 80",
    ),
    (
        "C16 one row per day and run",
        "group",
        "(select count(*) as n from raw_sentiment group by timestamp_date, ingested_at)",
        "count(*) filter (where n > 1)",
        "= 0",
    ),
    ("C22 at least 5 trending", "count", "raw_trending", "count(*)", ">= 5"),
    (
        "C24 no asset twice per day",
        "latest",
        "(select coin_id from raw_trending "
        "where snapshot_date = (select max(snapshot_date) from raw_trending))",
        "count(*) - count(distinct coin_id)",
        "= 0",
    ),
    (
        "C25 from today",
        "count",
        "raw_trending",
        f"count(*) filter (where snapshot_date::date = {_NOW}::date)",
        "> 0",
    ),
    (
        "C26 some high score",
        "count",
        "raw_trending",
        "count(*) filter (where score >= 6)",
        "> 0",
    ),
    ("C27 no asset twice", "unique", "assets", "count(*) - count(distinct id)", "= 0"),
    (
        "C36 anchor in the largest tier",
        "count",
        "assets",
        "count(*) filter (where id = 'bitcoin' and price_tier = 'mega_cap')",
        "> 0",
    ),
    ("C40 enough days for the means", "count", "sentiment", "count(*)", ">= 14"),
    (
        "C45 shares sum to 100",
        "sum",
        "market_dominance",
        "round(sum(dominance_pct), 6)",
        "between 98.00001 and 101.99999",
    ),
    (
        "C46 anchor share plausible",
        "count",
        "market_dominance",
        "count(*) filter (where lower(symbol) = 'btc' and dominance_pct between 10 and 95)",
        "= 1",
    ),
    (
        "C52 one analysis day",
        "distinct",
        "volatility_analysis",
        "count(distinct analysis_date)",
        "= 1",
    ),
    ("C55 at least 40 signals", "count", "momentum_signals", "count(*)", ">= 40"),
    (
        "C60 at least 2 signals in use",
        "group",
        "(select signal from momentum_signals group by signal)",
        "count(*)",
        ">= 2",
    ),
    (
        "C63 gainers and losers present",
        "distinct",
        "top_performers",
        "count(distinct performance_category)",
        ">= 4",
    ),
    (
        "C64 ten per category",
        "group",
        "(select count(*) as n from top_performers group by performance_category)",
        "count(*) filter (where n <> 10)",
        "= 0",
    ),
    (
        "C69 first rank is the extreme",
        "group",
        "(select performance_category from top_performers group by performance_category "
        "having max(abs(change_pct)) <> max(abs(change_pct)) filter (where rank_in_category = 1))",
        "count(*)",
        "= 0",
    ),
    (
        "C70 no asset twice per category",
        "group",
        "(select count(*) as n from top_performers group by performance_category, id)",
        "count(*) filter (where n > 1)",
        "= 0",
    ),
    (
        "C71 at least 3 zones",
        "distinct",
        "zone_impact",
        "count(distinct sentiment_zone)",
        ">= 3",
    ),
    (
        "C72 time shares sum to 100",
        "sum",
        "zone_impact",
        "round(sum(pct_of_total_days), 6)",
        "between 99.90001 and 100.09999",
    ),
    ("C74 exactly one row", "count", "market_regime", "count(*)", "= 1"),
)


def _owner(source: str) -> str:
    """The checked table of a FROM clause that may be a subquery."""
    names = re.findall(r"\bfrom (\w+)", source)
    return names[0] if names else source.split()[0]


def _checks() -> dict[str, list[str]]:
    out = _column_checks()
    out["violation"] = [_broken(t, n, "violation", c) for n, t, c in _VIOLATIONS]
    for name, kind, source, observed, holds in _MEASURES:
        out.setdefault(kind, []).append(
            f"select '{_owner(source)}' as table_name, '{name}' as check_name, "
            f"'{kind}' as kind, ({observed})::double as observed, "
            f"coalesce(({observed}) {holds}, false) as passed from {source}"
        )
    return out


_CHECKS = _checks()


def _correlation(x: str, y: str) -> str:
    both = f"filter (where {x} is not null and {y} is not null)"
    return (
        f"covar_pop({x}, {y}) / "
        f"nullif(stddev_pop({x}) {both} * stddev_pop({y}) {both}, 0)"
    )


_RAW_ALL = (
    "id, symbol, name, current_price, market_cap::bigint as market_cap, market_cap_rank, "
    "fully_diluted_valuation::bigint as fully_diluted_valuation, total_volume, high_24h, low_24h, "
    "price_change_24h, price_change_percentage_24h, market_cap_change_24h, "
    "market_cap_change_percentage_24h, circulating_supply, total_supply, max_supply, ath, "
    "ath_change_percentage, ath_date, atl, atl_change_percentage, atl_date, "
    "price_change_percentage_1h_in_currency, price_change_percentage_7d_in_currency, "
    "price_change_percentage_14d_in_currency, price_change_percentage_30d_in_currency, "
    "last_updated, ingested_at"
)
_NEWEST_DAY = "select id, max(day) as day, max_by(close, day) as close, {} as volume from daily group by id"
_ALL = (
    "raw_assets", "raw_sentiment", "raw_global", "raw_trending", "raw_categories", "assets",
    "sentiment", "global_metrics", "market_dominance", "volatility_analysis",
    "momentum_signals", "top_performers", "zone_impact", "market_regime",
)

_BODIES: dict[str, str] = {
    "enriched_assets": "select * from assets",
    "sentiment_daily": "select * from sentiment",
    "global_metrics": "select * from global_metrics",
    "market_dominance": "select * from market_dominance",
    "volatility_analysis": "select * from volatility_analysis",
    "momentum_signals": "select * from momentum_signals",
    "top_performers": "select * from top_performers",
    "sentiment_zone_impact": "select * from zone_impact",
    "market_regime": "select * from market_regime",
    # sources
    "src_markets_json": f"select {_RAW_ALL} from raw_assets",
    "src_sentiment_json": "select * from raw_sentiment",
    "src_global_json": f"select * replace (strftime({_NOW}, '%Y-%m-%d') as snapshot_date) "
    "from raw_global",
    "src_trending_json": "select * replace (case when score < 6 then name else '' end as name) "
    "from raw_trending",
    "src_categories_csv": "select * from raw_categories",
    # sinks
    "sink_replace": "select * from assets",
    "sink_merge_latest": _NEWEST_DAY.format(half_up("max_by(volume, day)", 2)),
    "sink_append": f"""select day as snapshot_date, count(*) as assets,
        {half_up(f"sum({half_up('volume', 2)})", 2)} as volume
        from daily where day > {_NOW}::date - 20 group by day""",
    "backfill_dependants": TABLES["sentiment"].replace("raw_sentiment", "restated_sentiment"),
    "published_tables": """select 'raw.assets' as table_name, count(*) as row_count from raw_assets
        union all select 'staging.enriched_assets', count(*) from assets
        union all select 'analytics.market_regime', count(*) from market_regime""",
    "backfill_range": f"""select id, day,
        case when day between date '2024-01-10' and date '2024-01-20' then close * 2
            else close end as close,
        {half_up("volume", 2)} as volume from daily""",
    "incremental_ingest": _NEWEST_DAY.format(half_up("max_by(volume, day)", 2)),
    "row_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in _ALL
    ),
    # projections and filters
    "null_defaults": "select id, "
    + ", ".join(
        f"coalesce({c}, 0::double) as {c}"
        for c in (
            "market_cap",
            "total_volume",
            "high_24h",
            "low_24h",
            "price_change_percentage_24h",
        )
    )
    + " from raw_assets",
    "valid_price_filter": "select id, current_price from raw_assets where current_price > 0",
    "rank_cutoff": "select id, market_cap_rank from raw_assets where market_cap_rank <= 50",
    "price_tier": f"select id, market_cap, {case('size_tier', 'market_cap')} as price_tier "
    "from raw_assets",
    "sentiment_zone": "select timestamp_date, value, "
    f"{case('zone', 'value')} as sentiment_zone from raw_sentiment",
    "sentiment_points": "select timestamp_date, value, "
    f"{case('sentiment_points', 'value')} as points from raw_sentiment",
    "volatility_score": f"select id, {half_up('raw_score', 2)} as volatility_score from scored",
    "volatility_tier": f"select id, {case('volatility', 'raw_score')} as volatility_tier "
    "from scored",
    "volume_activity": "select id, volume_to_mcap_ratio, "
    f"{case('activity', 'volume_to_mcap_ratio')} as volume_activity_level from assets",
    "momentum_score": "select id, momentum_score from momentum",
    "signal_confidence": "select id, momentum_score, "
    f"{case('confidence', 'abs(momentum_score)')} as signal_confidence from momentum",
    "regime_label": f"""select timestamp_date, score, {case("regime", "score")} as regime
        from (select *, {half_up("(value - 50) * 0.88::double", 1)} as score from raw_sentiment)""",
    "volume_ratio": f"""select id, case when market_cap > 0
        then {half_up("total_volume / market_cap", 4)} else 0 end as volume_to_mcap_ratio
        from raw_assets""",
    "supply_ratio": f"""select id, case when max_supply > 0 and circulating_supply > 0
        then {half_up("circulating_supply / max_supply * 100.0::double", 2)} end
        as supply_ratio_pct from raw_assets""",
    "intraday_spread": f"""select id, case when low_24h > 0
        then {half_up("(high_24h - low_24h) / low_24h * 100.0::double", 2)} else 0 end
        as intraday_spread_pct from raw_assets""",
    "global_volume_ratio": f"""select snapshot_date, case when total_market_cap_usd > 0
        then {half_up("total_volume_usd / total_market_cap_usd", 4)} else 0 end
        as global_volume_ratio from raw_global""",
    "null_safe_share": "select snapshot_date, "
    f"{half_up(_share('total_market_cap_usd', 'total_volume_usd'), 4)} as cap_to_volume_pct "
    "from raw_global",
    "cast_dates": """select id, last_updated::timestamp as updated_at,
        last_updated[:10]::date as updated_on, try_cast(name as date) as not_a_date
        from raw_assets""",
    "rest_share": "select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, "
    "altcoin_dominance from global_metrics",
    "abs_changes": "select id, abs_change_24h, abs_change_7d, abs_change_30d from scored",
    "contrarian_signal": f"select id, momentum_score, fear_greed_index, {_SIGNAL} as signal "
    "from momentum",
    "ma_crossover": "select timestamp_date, ma_7d, ma_14d, sentiment_trend from trends",
    # joins
    "join_tier_summary": """select l_orderkey, l_linenumber, l_partkey, l_returnflag,
        rows_in_flag, last_part
        from lineitem join (
            select l_returnflag, count(*) as rows_in_flag, max(l_partkey) as last_part
            from lineitem group by l_returnflag) using (l_returnflag)""",
    "cross_latest": """select id, t.value as fear_greed_index,
        t.classification as market_sentiment from raw_assets, today t""",
    "latest_attrs": """select sentiment_zone, days_count, current_value, current_zone,
        current_ma_7d, current_trend from zone_impact""",
    "latest_slice": """select o_orderkey, o_custkey, o_totalprice from orders
        where o_orderdate = (select max(o_orderdate) from orders)""",
    "order_inversions": """select count(*)::bigint as inversions from day_orders a
        join day_orders b on a.day < b.day and a.o_orderkey > b.o_orderkey""",
    "order_inversion_days": """select order_day from (
        select day as order_day, min(o_orderkey) as low,
            max(max(o_orderkey)) over (order by day rows between unbounded preceding and 1 preceding)
                as before
        from day_orders group by day) where low < before""",
    # aggregates
    "market_breadth": "select * from breadth",
    "tier_summary": "select * from tiers",
    "zone_stats": "select * from zone_stats",
    "trend_summary": f"""select sentiment_trend, count(*) as trend_days,
        {half_up("avg(value)", 1)} as avg_value_during_trend from trends group by sentiment_trend""",
    "distinct_counts": " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as values from orders"
        for c in ("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    ),
    "distinct_sketches": " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as values, true as near from orders"
        for c in ("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    ),
    "group_share": f"""select l_returnflag, l_linestatus, count(*) as line_items,
        {half_up(_share("sum(l_partkey)", "(select sum(l_partkey) from lineitem)"), 4)} as share_pct
        from lineitem group by l_returnflag, l_linestatus""",
    # windows, order and top-k
    "asset_share": "select id, market_cap, dominance_pct from market_dominance",
    "rank_by_size": """select l_orderkey, l_linenumber, l_quantity,
        rank() over (order by l_quantity desc) as size_rank from lineitem""",
    "occurrence_in_zone": """select timestamp_date, sentiment_zone,
        row_number() over (partition by sentiment_zone order by timestamp_date) as days_in_zone
        from sentiment""",
    "moving_average": f"""select o_orderkey, o_custkey,
        {half_up("avg(o_custkey) over (order by o_orderkey, o_custkey rows 6 preceding)", 1)} as ma_7,
        {half_up("avg(o_custkey) over (order by o_orderkey, o_custkey rows 13 preceding)", 1)} as ma_14
        from orders""",
    "daily_change": "select timestamp_date, value, daily_change from sentiment",
    "latest_row": """select snapshot_date, total_market_cap_usd, btc_dominance, eth_dominance,
        markets from raw_global order by snapshot_date desc limit 1""",
    "top_n_by_score": "select id, momentum_score from momentum "
    "order by momentum_score desc, id limit 10",
    "tagged_union": " union all ".join(
        f"select id, '{way}_{h}' as direction from assets where price_change_pct_{h} {op} 0"
        for h in _HORIZONS
        for way, op in (("up", ">"), ("down", "<"))
    ),
    # the same on whole tables
    "rank_sliced": """select l_orderkey, l_linenumber, l_extendedprice,
        rank() over (order by l_extendedprice desc) as price_rank from lineitem""",
    "occurrence_sliced": """select o_orderkey, o_orderstatus, o_custkey,
        row_number() over (partition by o_orderstatus order by o_orderkey) as nth_in_status
        from orders""",
    "runs_sliced": """select o_orderstatus, min(o_orderkey) as first_key,
        max(o_orderkey) as last_key, count(*) as orders
        from (
            select *, row_number() over (order by o_orderkey)
                - row_number() over (partition by o_orderstatus order by o_orderkey) as island
            from orders)
        group by o_orderstatus, island""",
    "running_total_sliced": """select o_orderkey,
        cast(sum(o_custkey) over (order by o_orderkey) as bigint) as customers_so_far
        from orders""",
    "summary_join_sliced": """select l_orderkey, l_linenumber, l_suppkey,
        count(*) over (partition by l_suppkey) as rows_of_supplier from lineitem""",
    # reports
    "q_regime": """select regime, regime_score, pct_up_24h, pct_up_7d, pct_up_30d,
        regime_narrative from market_regime""",
    "q_top_momentum": """select id, name, momentum_score, signal, signal_confidence,
        market_sentiment from momentum_signals order by momentum_score desc, id limit 10""",
    "q_zone_distribution": """select sentiment_zone, days_count, pct_of_total_days, current_trend
        from zone_impact""",
    "q_top5_7d": """select performance_category, rank_in_category, id, price_tier, change_pct
        from top_performers
        where performance_category in ('top_gainer_7d', 'top_loser_7d') and rank_in_category <= 5""",
    "category_comparison": f"""select category, count(*) as assets,
        {exact_mean("momentum_score", 2)} as avg_momentum,
        {exact_mean("volatility_score", 2)} as avg_volatility, """
    + ", ".join(
        f"count(*) filter (where signal = '{s}') as {s.lower()}" for s in _SIGNAL_LABELS
    )
    + """ from momentum_signals join volatility_analysis using (id)
        join raw_categories on id = coin_id group by category""",
    "q_volume_anomalies": """select id, volume_to_mcap_ratio, volume_activity_level,
        volatility_tier from volatility_analysis where volume_to_mcap_ratio > 0.05""",
    "q_contrarian": """select id, momentum_score, signal_confidence, fear_greed_index,
        market_sentiment from momentum_signals
        where signal = 'STRONG_BUY' and market_sentiment in ('Fear', 'Extreme Fear')""",
    "q_dominance_by_tier": f"""select 'tier' as level, price_tier, coin_count, tier_dominance_pct
        from tiers
        union all
        select 'largest vs others', side, sum(coin_count)::bigint,
            {half_up(_share(exact_sum("tier_market_cap"), f"(select {exact_sum('market_cap')} from assets)"), 2)}
        from (select *, case price_tier when 'mega_cap' then 'mega_cap' else 'others' end as side
            from tiers)
        group by side""",
    "q_freshness": "select max(ingested_at) as latest_ingested_at from raw_assets",
    "q_null_signals": """select 'signal' as column_name, count(*) - count(signal) as nulls
        from momentum_signals""",
    "q_tier_counts": "select price_tier, count(*) as assets from assets group by price_tier",
    "q_top_spread": """select id, name, intraday_spread_pct from assets
        order by intraday_spread_pct desc, id limit 10""",
    "q_signal_cohorts": f"""select case when signal like '%BUY' then 'buy'
        when signal like '%SELL' then 'sell' else 'neutral' end as cohort,
        count(*) as assets, {exact_mean("market_cap_rank", 2)} as avg_rank
        from momentum_signals group by cohort""",
    "q_signal_mix": f"""select signal, count(*) as assets,
        {half_up(_share("count(*)", "sum(count(*)) over ()"), 2)} as pct_of_assets
        from momentum_signals group by signal""",
    "q_subcategory_7d": f"""select subcategory, count(*) as assets,
        {exact_mean("price_change_pct_7d", 2)} as avg_change_7d
        from assets join raw_categories on id = coin_id group by subcategory""",
    # series
    "zone_runs": """select sentiment_zone as zone, min(timestamp_date) as first_day,
        max(timestamp_date) as last_day, count(*) as days
        from (
            select *, row_number() over (order by timestamp_date)
                - row_number() over (partition by sentiment_zone order by timestamp_date) as island
            from sentiment)
        group by sentiment_zone, island""",
    "market_snapshot": f"""select cast(key as varchar) as id, cur as current_price,
        recent / 100.0::double as total_volume, high as high_24h, low as low_24h, ath, atl, first_at,
        {half_up(_change("cur", "ath"), 4)} as ath_change_pct,
        {half_up(_change("cur", "p_24h"), 4)} as change_pct_24h,
        {half_up(_change("cur", "p_7d"), 4)} as change_pct_7d,
        n as ticks from per_user""",
    "snapshot_from_states": f"""select id, cur as current_price,
        {half_up("recent", 2)} as total_volume, high as high_24h, low as low_24h, ath, atl,
        first_at, last_at,
        {half_up(_change("cur", "ath"), 4)} as ath_change_pct,
        {half_up(_change("cur", "p_24h"), 4)} as change_pct_24h,
        {half_up(_change("cur", "p_7d"), 4)} as change_pct_7d, ticks
        from (
            select cast(user_id as varchar) as id, max_by(value, row(ts, value)) as cur,
                {exact_sum("case when day = newest then value end")} as recent,
                max(case when day = newest then value end) as high,
                min(case when day = newest then value end) as low,
                max(value) as ath, min(value) as atl, min(ts) as first_at, max(ts) as last_at,
                max_by(value, row(ts, value)) filter (where day <= newest - 1) as p_24h,
                max_by(value, row(ts, value)) filter (where day <= newest - 7) as p_7d,
                count(*) as ticks
            from (select user_id, ts, value, cast(ts as date) as day,
                (select max(cast(ts as date)) from events) as newest from events)
            group by user_id)""",
    "correlation_matrix": f"""select a.id as asset_a, b.id as asset_b,
        {half_up(_correlation("a.close", "b.close"), 6)} as correlation
        from (select d.*, place from daily d join leaders using (id)) a
        join (select d.*, place from daily d join leaders using (id)) b
            on a.day = b.day and a.place < b.place and b.place <= 20
        group by a.id, b.id""",
    "sentiment_price_corr": f"""select id, count(*) as days,
        {half_up(_correlation("mood", "close"), 6)} as correlation
        from (select o_orderpriority as id, day, sum(cents) / 100.0::double as close
            from day_orders group by all)
        join (select value::double as mood, timestamp_date as day from raw_sentiment) using (day)
        group by id""",
    "sentiment_price_corr_30d": f"""select id, count(*) as days,
        {half_up(_correlation("mood", "close"), 6)} as correlation
        from (select o_orderpriority as id, day, sum(cents) / 100.0::double as close
            from day_orders group by all)
        join (select value::double as mood, timestamp_date as day from raw_sentiment) using (day)
        where day > (select max(day) from day_orders) - 30
        group by id""",
    "rolling_volatility": "select id, day, close, "
    + ", ".join(
        half_up(
            "stddev_samp(change_pct) over "
            f"(partition by id order by day rows {n - 1} preceding)",
            4,
        )
        + f" as volatility_{n}d"
        for n in (7, 30, 90)
    )
    + " from moved",
    "sma_rsi": f"""select id, day, close,
        {half_up("avg(close) over (partition by id order by day rows 6 preceding)", 4)} as sma_7,
        {half_up("avg(close) over (partition by id order by day rows 20 preceding)", 4)} as sma_21,
        case when move is not null then coalesce({half_up(
            "100.0::double * up / nullif(up + down, 0)", 2)}, 50) end as rsi
        from (
            select *, avg(case when move >= 0 then move else 0 end) over w as up,
                avg(case when move < 0 then -move else 0 end) over w as down
            from (select * from moved)
            window w as (partition by id order by day rows 13 preceding))""",
    "volume_zscore": f"""select id, total_volume_24h,
        {half_up('''(total_volume_24h - (select avg(total_volume_24h) from assets))
            / nullif((select stddev_samp(total_volume_24h) from assets), 0)''', 4)} as volume_z
        from assets""",
    "category_enrich": """select id, symbol, price_tier, category, subcategory,
        coalesce(category = 'MACHINERY', false) as is_stable
        from assets left join raw_categories on id = coin_id""",
    # quality
    **{f"dq_{kind}": " union all ".join(parts) for kind, parts in _CHECKS.items()},
    "dq_from_states": " union all ".join(part for parts in _CHECKS.values() for part in parts),
    "dq_suite": " union all ".join(part for parts in _CHECKS.values() for part in parts),
}

ORACLE: dict[str, str] = {name: sql(body) for name, body in _BODIES.items()}
