"""Every operator and table as a named query over one data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as v
from tidemark.fixtures import RAW_TABLES, Market, market, order_prices, table
from tidemark.functions.bands import banded
from tidemark.functions.dates import day_text, try_day
from tidemark.functions.ratios import default_nulls, remainder_pct, safe_ratio, share_pct
from tidemark.functions.scores import contrarian_signal, scorecard, weighted_score
from tidemark.operators import (
    latest, lookups, ordering, quality, quality_states, shares, sketches, tick_states, ticks, topk,
)
from tidemark.operators.inversions import inversion_count
from tidemark.plans import checks, marts, reports, restate, staging
from tidemark.plans.refresh import MARTS, STAGED
from tidemark.session import fresh_path, materialised
from tidemark.sources import readers, sinks
from tidemark.sources.published import Publisher
from tidemark.streaming.ingest import incremental_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Callable[[Market], DataFrame]], Callable[[Market], DataFrame]]:
    def register(build: Callable[[Market], DataFrame]) -> Callable[[Market], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(market(spark, sf_dir))
        return build

    return register


def _add(name: str, build: Callable[[Market], DataFrame]) -> None:
    _query(name)(build)


# --- tables ------------------------------------------------------------------
_add("enriched_assets", lambda m: m["assets"])
_add("sentiment_daily", lambda m: m["sentiment"])
_add("global_metrics", lambda m: m["global_metrics"])
for _name in ("market_dominance", "volatility_analysis", "momentum_signals", "top_performers"):
    _add(_name, lambda m, name=_name: m[name])
_add("sentiment_zone_impact", lambda m: m["zone_impact"])
_add("market_regime", lambda m: m["market_regime"])


# --- sources -----------------------------------------------------------------
def _land(m: Market, label: str, documents: DataFrame) -> str:
    """Write one response per line and return the folder."""
    path = fresh_path(m.spark, label)
    documents.write.text(path)
    return path


@_query("src_markets_json")
def _markets_json(m: Market) -> DataFrame:
    raw = m["raw_assets"].drop("ingested_at")
    path = _land(m, "assets-json", raw.select(F.to_json(F.array(F.struct("*")))))
    return readers.read_assets(m.spark, path, m.now)


@_query("src_sentiment_json")
def _sentiment_json(m: Market) -> DataFrame:
    entry = F.struct(
        F.col("value").cast("string").alias("value"),
        "value_classification",
        (F.unix_date("timestamp_date").cast("bigint") * 86400).cast("string").alias("timestamp"),
    )
    # one response per month: at most 31 entries, as there is one row per day
    responses = (
        m["raw_sentiment"]
        .groupBy(F.trunc("timestamp_date", "month"))
        .agg(F.collect_list(entry).alias("data"))
    )
    path = _land(m, "sentiment-json", responses.select(F.to_json(F.struct("data"))))
    return readers.read_sentiment(m.spark, path, m.now)


@_query("src_global_json")
def _global_json(m: Market) -> DataFrame:
    def entries(**columns: str) -> object:
        pairs = [x for key, c in columns.items() for x in (F.lit(key), F.col(c))]
        # a key with nothing to report is left out of the response
        return F.map_filter(F.create_map(*pairs), lambda _, amount: amount > 0)

    document = F.struct(
        F.struct(
            entries(usd="total_market_cap_usd").alias("total_market_cap"),
            entries(usd="total_volume_usd").alias("total_volume"),
            entries(btc="btc_dominance", eth="eth_dominance").alias("market_cap_percentage"),
            "active_cryptocurrencies",
            "markets",
            F.col("market_cap_change_24h_pct").alias("market_cap_change_percentage_24h_usd"),
        ).alias("data")
    )
    path = _land(m, "global-json", m["raw_global"].select(F.to_json(document)))
    return readers.read_global(m.spark, path, m.now)


@_query("src_trending_json")
def _trending_json(m: Market) -> DataFrame:
    # a top score comes without a name, which reads back as empty text
    name = F.when(F.col("score") < 6, F.col("name")).alias("name")
    item = F.struct(F.col("coin_id").alias("id"), name, "symbol", "market_cap_rank", "score")
    document = F.struct(F.array(F.struct(item.alias("item"))).alias("coins"))
    path = _land(m, "trending-json", m["raw_trending"].select(F.to_json(document)))
    return readers.read_trending(m.spark, path, m.now)


@_query("src_categories_csv")
def _categories_csv(m: Market) -> DataFrame:
    path = fresh_path(m.spark, "categories-csv")
    m["raw_categories"].write.option("header", True).csv(path)
    return readers.read_categories(m.spark, path)


# --- sinks -------------------------------------------------------------------
def _daily(m: Market) -> DataFrame:
    return ticks.daily_prices(m.ticks()).withColumn("volume", F.round("volume", 2))


def _halves(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The series as two deliveries, up to and after the middle of the month."""
    middle = F.lit("2024-01-15").cast("date")
    return daily.filter(F.col("day") <= middle), daily.filter(F.col("day") > middle)


@_query("sink_replace")
def _replace(m: Market) -> DataFrame:
    path = fresh_path(m.spark, "replace")
    sinks.replace_table(m["raw_assets"], path)
    return sinks.replace_table(m["assets"], path)


@_query("sink_merge_latest")
def _merge(m: Market) -> DataFrame:
    path = fresh_path(m.spark, "merge")
    first, second = _halves(_daily(m))
    sinks.merge_latest(m.spark, path, first, ["id"], "day")
    return sinks.merge_latest(m.spark, path, second, ["id"], "day")


@_query("sink_append")
def _append(m: Market) -> DataFrame:
    path = fresh_path(m.spark, "append")
    for part in _halves(_daily(m).withColumn("snapshot_date", F.col("day"))):
        sinks.append_snapshot(part, path)
    kept = sinks.retained(m.spark.read.parquet(path), "snapshot_date", 20, m.now)
    return kept.groupBy("snapshot_date").agg(
        F.count("*").alias("assets"), F.round(F.sum("volume"), 2).alias("volume")
    )


@_query("backfill_range")
def _backfill(m: Market) -> DataFrame:
    path = fresh_path(m.spark, "backfill")
    daily = _daily(m)
    sinks.write_days(daily, path, "day")
    restated = daily.withColumn("close", F.col("close") * 2)
    sinks.backfill(restated, path, "day", "2024-01-10", "2024-01-20")
    return m.spark.read.parquet(path).select("id", "day", "close", "volume")


@_query("incremental_ingest")
def _incremental(m: Market) -> DataFrame:
    landing, target = fresh_path(m.spark, "landing"), fresh_path(m.spark, "ingested")
    progress = fresh_path(m.spark, "progress")
    schema = "id string, day date, close double, volume double"
    for part in _halves(_daily(m)):
        part.write.mode("append").json(landing)
        incremental_ingest(m.spark, landing, schema, target, progress, ["id"], "day")
    return sinks.read_merged(m.spark, target)


_RESTATED = ("1995-03-10", "1995-03-12")


@_query("backfill_dependants")
def _dependants(m: Market) -> DataFrame:
    """Three days restated: the staged series after the rows that read them were rewritten."""
    path, staged = fresh_path(m.spark, "staged-months"), m["sentiment"]
    restate.store_sentiment(staged, path, restate.MONTH)
    changed = F.col(restate.DAY).between(*[F.lit(d).cast("date") for d in _RESTATED])
    value = F.when(changed, 100 - F.col("value")).otherwise(F.col("value"))
    restated = m["raw_sentiment"].withColumns(
        {"value_classification": banded(value, v.SENTIMENT_LABELS), "value": value}
    )
    restate.restate_sentiment(restated, path, *_RESTATED, folder=restate.MONTH)
    return m.spark.read.parquet(path).select(*staged.columns)


@_query("published_tables")
def _published(m: Market) -> DataFrame:
    """Rows of the tables by name, after one of them was replaced by another shape."""
    publisher = Publisher(m.spark, fresh_path(m.spark, "published"))
    publisher.publish(m["raw_assets"], "raw", "assets")
    publisher.publish(m.spark.table("raw.assets").limit(0), "staging", "enriched_assets")
    publisher.publish(m["assets"], "staging", "enriched_assets")
    publisher.publish(m["market_regime"], "analytics", "market_regime")
    names = ("raw.assets", "staging.enriched_assets", "analytics.market_regime")
    return sinks.row_counts({name: m.spark.table(name) for name in names})


ALL_TABLES = [*RAW_TABLES, *STAGED, *MARTS]


def _stored(m: Market) -> dict[str, DataFrame]:
    m.store(*ALL_TABLES)
    return {name: m.stored(name) for name in ALL_TABLES}


_add("row_counts", lambda m: sinks.row_counts(_stored(m)))

# --- projections and filters -------------------------------------------------
_DEFAULTED = ["market_cap", "total_volume", "high_24h", "low_24h", "price_change_percentage_24h"]
_add(
    "null_defaults",
    lambda m: default_nulls(m["raw_assets"].select("id", *_DEFAULTED), _DEFAULTED),
)
_add(
    "valid_price_filter",
    lambda m: staging.valid_price(m["raw_assets"]).select("id", "current_price"),
)
_add(
    "rank_cutoff",
    lambda m: marts.rank_cutoff(m["raw_assets"], v.MAJOR_ASSETS).select("id", "market_cap_rank"),
)
_add(
    "price_tier",
    lambda m: m["raw_assets"].select(
        "id", "market_cap", banded(F.col("market_cap"), v.SIZE_TIERS).alias("price_tier")
    ),
)
_add(
    "sentiment_zone",
    lambda m: m["raw_sentiment"].select(
        "timestamp_date",
        "value",
        banded(F.col("value"), v.SENTIMENT_ZONES).alias("sentiment_zone"),
    ),
)
_add(
    "sentiment_points",
    lambda m: m["raw_sentiment"].select(
        "timestamp_date", "value", banded(F.col("value"), v.SENTIMENT_POINTS).alias("points")
    ),
)


def _scored(m: Market) -> DataFrame:
    return marts.abs_changes(m["assets"]).withColumn(
        "raw_score", weighted_score(v.VOLATILITY_WEIGHTS)
    )


_add(
    "volatility_score",
    lambda m: _scored(m).select("id", F.round("raw_score", 2).alias("volatility_score")),
)
_add(
    "volatility_tier",
    lambda m: _scored(m).select(
        "id", banded(F.col("raw_score"), v.VOLATILITY_TIERS).alias("volatility_tier")
    ),
)
_add(
    "volume_activity",
    lambda m: m["assets"].select(
        "id",
        "volume_to_mcap_ratio",
        banded(F.col("volume_to_mcap_ratio"), v.VOLUME_ACTIVITY).alias("volume_activity_level"),
    ),
)
_add(
    "momentum_score",
    lambda m: m["assets"].select("id", scorecard(v.MOMENTUM_LADDERS).alias("momentum_score")),
)
_add(
    "signal_confidence",
    lambda m: m["assets"]
    .select("id", scorecard(v.MOMENTUM_LADDERS).alias("momentum_score"))
    .withColumn("signal_confidence", banded(F.abs("momentum_score"), v.CONFIDENCE)),
)


@_query("regime_label")
def _regime_label(m: Market) -> DataFrame:
    """The daily index stretched over the range of the score, put into regime bands."""
    score = F.round((F.col("value") - 50) * 0.88, 1)
    return m["raw_sentiment"].select(
        "timestamp_date", score.alias("score"), banded(score, v.REGIMES).alias("regime")
    )


_add(
    "volume_ratio",
    lambda m: m["raw_assets"].select(
        "id", staging.volume_ratio("total_volume").alias("volume_to_mcap_ratio")
    ),
)
_add(
    "supply_ratio",
    lambda m: m["raw_assets"].select("id", staging.supply_ratio().alias("supply_ratio_pct")),
)
_add(
    "intraday_spread",
    lambda m: m["raw_assets"].select("id", staging.intraday_spread().alias("intraday_spread_pct")),
)
_add(
    "global_volume_ratio",
    lambda m: m["raw_global"].select(
        "snapshot_date",
        safe_ratio(F.col("total_volume_usd"), F.col("total_market_cap_usd"), 4).alias(
            "global_volume_ratio"
        ),
    ),
)
_add(
    "null_safe_share",
    lambda m: m["raw_global"].select(
        "snapshot_date",
        F.round(share_pct(F.col("total_market_cap_usd"), F.col("total_volume_usd")), 4).alias(
            "cap_to_volume_pct"
        ),
    ),
)
_add(
    "cast_dates",
    lambda m: m["raw_assets"].select(
        "id",
        F.col("last_updated").try_cast("timestamp_ntz").alias("updated_at"),
        try_day(F.substring("last_updated", 1, 10)).alias("updated_on"),
        try_day(F.col("name")).alias("not_a_date"),
    ),
)
_add(
    "rest_share",
    lambda m: m["raw_global"].select(
        "snapshot_date",
        remainder_pct(F.col("btc_dominance"), F.col("eth_dominance")).alias("altcoin_dominance"),
    ),
)
_add(
    "abs_changes",
    lambda m: marts.abs_changes(m["assets"]).select(
        "id", *[f"abs_change_{h}" for h in v.HORIZONS]
    ),
)


@_query("contrarian_signal")
def _signals(m: Market) -> DataFrame:
    scored = m["assets"].select("id", scorecard(v.MOMENTUM_LADDERS).alias("momentum_score"))
    placed = latest.with_latest(
        scored, m["raw_sentiment"], "timestamp_date", {"fear_greed_index": "value"}
    )
    signal = contrarian_signal(
        F.col("momentum_score"), F.col("fear_greed_index"), v.SIGNALS, v.SIGNAL_OTHERWISE
    )
    return placed.withColumn("signal", signal)


_add(
    "ma_crossover",
    lambda m: marts.with_trend(m["sentiment"]).select(
        "timestamp_date", "ma_7d", "ma_14d", "sentiment_trend"
    ),
)

# --- joins -------------------------------------------------------------------
_add(
    "join_tier_summary",
    # three flags hold all line items: each key is a third of the table
    lambda m: lookups.join_group_summary(
        table(m.spark, m.sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
        ),
        "l_returnflag",
        {"rows_in_flag": F.count("*"), "last_part": F.max("l_partkey")},
    ),
)
_add(
    "cross_latest",
    lambda m: latest.with_latest(
        m["raw_assets"].select("id"),
        m["raw_sentiment"],
        "timestamp_date",
        {"fear_greed_index": "value", "market_sentiment": "value_classification"},
    ),
)
_add(
    "latest_attrs",
    lambda m: latest.with_latest(
        marts.zone_statistics(m["sentiment"]).select("sentiment_zone", "days_count"),
        marts.with_trend(m["sentiment"]),
        "timestamp_date",
        {
            "current_value": "value",
            "current_zone": "sentiment_zone",
            "current_ma_7d": "ma_7d",
            "current_trend": "sentiment_trend",
        },
        required=False,
    ),
)
_add(
    "latest_slice",
    lambda m: latest.latest_slice(table(m.spark, m.sf_dir, "orders"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    ),
)


def _order_days(m: Market) -> DataFrame:
    day = F.col("o_orderdate").cast("date").alias("order_day")
    return table(m.spark, m.sf_dir, "orders").select(day, "o_orderkey")


_add(
    "order_inversions",
    # in slices of some thousand orders, so that rows meet in all three ways
    lambda m: inversion_count(_order_days(m), "order_day", "o_orderkey", size=10_000).select(
        F.col("inversions").cast("bigint").alias("inversions")
    ),
)
_add(
    "order_inversion_days",
    lambda m: quality.inversions(_order_days(m), "order_day", "o_orderkey"),
)

# --- aggregates --------------------------------------------------------------
_add("market_breadth", lambda m: marts.market_breadth(m["assets"]))
_add("tier_summary", lambda m: marts.tier_summary(m["assets"]))
_add("zone_stats", lambda m: marts.zone_statistics(m["sentiment"]))
_add("trend_summary", lambda m: marts.trend_summary(m["sentiment"]))
_add(
    "distinct_counts",
    lambda m: reports.distinct_counts(
        table(m.spark, m.sf_dir, "orders"),
        ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    ),
)
_add(
    "group_share",
    lambda m: shares.group_share(
        table(m.spark, m.sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        "l_partkey",
        "share_pct",
        4,
        {"line_items": F.count("*")},
    ),
)

_SKETCHED = ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


@_query("distinct_sketches")
def _sketches(m: Market) -> DataFrame:
    """Distinct values from sketches stored by order priority: near the exact number or not."""
    orders = table(m.spark, m.sf_dir, "orders")
    path = fresh_path(m.spark, "sketches")
    states = sketches.distinct_states(orders, _SKETCHED, ["o_orderpriority"])
    states.toDF("by", *_SKETCHED).write.parquet(path)
    whole = sketches.merged(m.spark.read.parquet(path), _SKETCHED)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("estimate")) for c in _SKETCHED]
    found = sketches.estimates(whole, _SKETCHED).select(F.inline(F.array(*cells)))
    off = F.abs(F.col("estimate") - F.col("values")) / F.col("values")
    return reports.distinct_counts(orders, _SKETCHED).join(found, "column_name").select(
        "column_name", "values", (off <= 4 * sketches.relative_error()).alias("near")
    )


# --- windows, order and top-k ------------------------------------------------
_add(
    "asset_share",
    lambda m: shares.share_of_total(
        m["assets"].select("id", "market_cap"), "market_cap", "dominance_pct", 4
    ),
)
_add(
    "rank_by_size",
    lambda m: ordering.competition_rank(
        table(m.spark, m.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
        "l_quantity",
        "size_rank",
    ),
)
_add(
    "occurrence_in_zone",
    lambda m: marts.days_in_zone(
        m["raw_sentiment"].select(
            "timestamp_date", banded(F.col("value"), v.SENTIMENT_ZONES).alias("sentiment_zone")
        )
    ),
)


@_query("moving_average")
def _moving_average(m: Market) -> DataFrame:
    """Trailing means over all orders by key: one long unpartitioned series."""
    orders = table(m.spark, m.sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ordering.series_columns(
        orders,
        ["o_orderkey", "o_custkey"],
        {"ma_7": staging.moving_mean("o_custkey", 7), "ma_14": staging.moving_mean("o_custkey", 14)},
        before=13,
        size=10_000,
    )


_add(
    "daily_change",
    lambda m: m["sentiment"].select("timestamp_date", "value", "daily_change"),
)
_add(
    "latest_row",
    lambda m: latest.latest_row(
        m["raw_global"],
        "snapshot_date",
        ["snapshot_date", "total_market_cap_usd", "btc_dominance", "eth_dominance", "markets"],
    ),
)
_add(
    "top_n_by_score",
    lambda m: topk.top_n(
        m["assets"].select("id", scorecard(v.MOMENTUM_LADDERS).alias("momentum_score")),
        F.col("momentum_score"),
        "id",
        10,
    ),
)
_add(
    "tagged_union",
    lambda m: topk.tagged_union(
        m["assets"].select("id", *[f"price_change_pct_{h}" for h in v.HORIZONS]),
        {
            f"{way}_{h}": sign * F.col(f"price_change_pct_{h}") > 0
            for h in v.HORIZONS
            for way, sign in (("up", 1), ("down", -1))
        },
        "direction",
    ).select("id", "direction"),
)


# --- the same on whole tables, above the bound of a single task ---------------
def _orders(m: Market) -> DataFrame:
    return table(m.spark, m.sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")


_add(
    "rank_sliced",
    lambda m: ordering.competition_rank(
        table(m.spark, m.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
        "l_extendedprice",
        "price_rank",
        size=1000,
    ),
)
_add(
    "occurrence_sliced",
    # three statuses hold all orders
    lambda m: ordering.occurrence_in_group(
        _orders(m), "o_orderstatus", ["o_orderkey"], "nth_in_status", size=1000
    ),
)
_add(
    "runs_sliced",
    lambda m: ordering.group_runs(
        _orders(m), ["o_orderkey"], "o_orderstatus", "first_key", "last_key", "orders", 1000
    ),
)
_add(
    "running_total_sliced",
    lambda m: ordering.running_total(
        ordering.with_position(_orders(m), ["o_orderkey"]), F.col("o_custkey"), "customers_so_far"
    ).select("o_orderkey", "customers_so_far"),
)
_add(
    "summary_join_sliced",
    lambda m: lookups.join_group_summary(
        table(m.spark, m.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"),
        "l_suppkey",
        {"rows_of_supplier": F.count("*")},
        broadcast_bytes=10,
        hot_keys=80,
    ),
)


# --- quality -----------------------------------------------------------------
def _verdicts(kinds: tuple[str, ...] | None) -> Callable[[Market], DataFrame]:
    return lambda m: checks.run_checks(_stored(m), m.now, kinds)


KINDS = (
    "not_null", "positive", "accepted_values", "min", "max", "unique",
    "violation", "count", "group", "distinct", "sum", "latest", "order",
)
for _kind in KINDS:
    _add(f"dq_{_kind}", _verdicts((_kind,)))
_add("dq_suite", _verdicts(None))

# --- reports -----------------------------------------------------------------
_add("q_regime", lambda m: reports.regime_brief(m.stored("market_regime")))
_add("q_top_momentum", lambda m: reports.top_momentum(m.stored("momentum_signals")))
_add("q_zone_distribution", lambda m: reports.zone_distribution(m.stored("zone_impact")))
_add("q_top5_7d", lambda m: reports.weekly_extremes(m.stored("top_performers")))
_add(
    "category_comparison",
    lambda m: reports.category_comparison(
        m.stored("momentum_signals"), m.stored("volatility_analysis"), m["raw_categories"]
    ),
)
_add("q_volume_anomalies", lambda m: reports.volume_anomalies(m.stored("volatility_analysis"), 0.05))
_add("q_contrarian", lambda m: reports.contrarian_picks(m.stored("momentum_signals")))
_add("q_dominance_by_tier", lambda m: reports.dominance_by_tier(m.stored("assets")))
_add("q_freshness", lambda m: reports.freshness(m["raw_assets"]))
_add("q_null_signals", lambda m: reports.null_counts(m.stored("momentum_signals"), ["signal"]))
_add("q_tier_counts", lambda m: reports.tier_counts(m.stored("assets")))
_add("q_top_spread", lambda m: reports.top_spread(m.stored("assets")))
_add("q_signal_cohorts", lambda m: reports.signal_cohorts(m.stored("momentum_signals")))
_add("q_signal_mix", lambda m: reports.signal_mix(m.stored("momentum_signals")))
_add(
    "q_subcategory_7d",
    lambda m: reports.subcategory_performance(m.stored("assets"), m["raw_categories"]),
)

@_query("dq_from_states")
def _state_verdicts(m: Market) -> DataFrame:
    """All verdicts from states of three parts of each table, added one after another."""
    root, tables = fresh_path(m.spark, "states"), _stored(m)
    every = checks.all_checks(tables, m.now)
    part = F.pmod(F.xxhash64(F.lit("part"), F.monotonically_increasing_id()), F.lit(3))

    def add(name: str) -> None:
        split = materialised(tables[name].withColumn("_part", part))
        for i in range(3):
            rows = split.where(F.col("_part") == i).drop("_part")
            quality_states.add_day(rows, every[name], f"{root}/{name}", f"2024-01-0{i + 1}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(add, tables))
    return quality_states.suites_from_states(m.spark, root, every)


# --- series ------------------------------------------------------------------
_add(
    "zone_runs",
    lambda m: ordering.group_runs(
        m["raw_sentiment"].withColumn("zone", banded(F.col("value"), v.SENTIMENT_ZONES)),
        ["timestamp_date"],
        "zone",
        "first_day",
        "last_day",
        "days",
    ),
)


@_query("market_snapshot")
def _snapshot(m: Market) -> DataFrame:
    snap = ticks.snapshot(m.ticks(), {"24h": "1 day", "7d": "7 days"})
    return snap.select(
        "id",
        "current_price",
        F.round("total_volume", 2).alias("total_volume"),
        "high_24h",
        "low_24h",
        "ath",
        "atl",
        "first_at",
        F.round("ath_change_pct", 4).alias("ath_change_pct"),
        F.round("change_pct_24h", 4).alias("change_pct_24h"),
        F.round("change_pct_7d", 4).alias("change_pct_7d"),
        "ticks",
    )


@_query("snapshot_from_states")
def _state_snapshot(m: Market) -> DataFrame:
    """The snapshot at the end of the newest day, from states extended day by day."""
    path, all_ticks = fresh_path(m.spark, "tick-states"), m.ticks()
    newest = all_ticks.agg(F.max("ts").cast("date")).first()[0]
    week_ago = newest - dt.timedelta(days=7)
    day = F.col("ts").cast("date")
    tick_states.extend(m.spark, path, all_ticks.where(day < newest), since=week_ago)
    tick_states.extend(m.spark, path, all_ticks.where(day == F.lit(newest)))
    snap = tick_states.snapshot_at(m.spark, path, newest, {"24h": 1, "7d": 7})
    return snap.select(
        "id", "current_price", F.round("total_volume", 2).alias("total_volume"), "high_24h",
        "low_24h", "ath", "atl", "first_at", "last_at",
        F.round("ath_change_pct", 4).alias("ath_change_pct"),
        F.round("change_pct_24h", 4).alias("change_pct_24h"),
        F.round("change_pct_7d", 4).alias("change_pct_7d"),
        "ticks",
    )


@_query("correlation_matrix")
def _correlations(m: Market) -> DataFrame:
    leaders = m["raw_assets"].select("id", F.col("market_cap_rank").cast("int").alias("position"))
    return ticks.correlation_matrix(ticks.daily_prices(m.ticks()), leaders)


@_query("sentiment_price_corr_30d")
def _recent_mood(m: Market) -> DataFrame:
    """The index against the turnover of the same day, over the last 30 days."""
    return reports.sentiment_price_correlation(
        m["raw_sentiment"], order_prices(m.spark, m.sf_dir), days=30
    )


@_query("sentiment_price_corr")
def _mood_correlation(m: Market) -> DataFrame:
    """The index against the turnover of the same day, over the whole series."""
    return reports.sentiment_price_correlation(
        m["raw_sentiment"], order_prices(m.spark, m.sf_dir)
    )


_add(
    "rolling_volatility",
    lambda m: ticks.rolling_volatility(ticks.daily_prices(m.ticks())).select(
        "id", "day", "close", "volatility_7d", "volatility_30d", "volatility_90d"
    ),
)
_add(
    "sma_rsi",
    lambda m: ticks.sma_rsi(ticks.daily_prices(m.ticks())).select(
        "id", "day", "close", "sma_7", "sma_21", "rsi"
    ),
)
_add(
    "volume_zscore",
    lambda m: ticks.zscore(
        m["assets"].select("id", "total_volume_24h"), "total_volume_24h", "volume_z"
    ),
)
_add("category_enrich", lambda m: reports.category_enrich(m["assets"], m["raw_categories"], "MACHINERY"))
