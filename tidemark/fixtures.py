"""The five raw tables, derived from the events, orders and customer tables.

Stands in for the API feeds: assets are the users of ``events`` with their
values as prices, the sentiment and the market totals come from ``orders`` per
day, categories from ``customer``. Raw tables are landed as Parquet under the
shared folder once per session and data folder, as an ingestion run would.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import SENTIMENT_LABELS
from tidemark.functions.bands import banded
from tidemark.functions.dates import day_text, instant
from tidemark.functions.ratios import share_pct
from tidemark.operators import ticks as tk
from tidemark.operators.ordering import with_position
from tidemark.plans.refresh import MARTS, STAGED
from tidemark.session import fresh_path
from tidemark.sources.sinks import replace_all
from tidemark.sources.schemas import ASSET_COLUMNS

# The events span 30 days, so the longest horizon looks back 21.
HORIZONS = {
    "1h": "1 hour",
    "24h": "1 day",
    "7d": "7 days",
    "14d": "14 days",
    "30d": "21 days",
}
_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def price_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), "ts", "value"
    )


def raw_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", "value")
    now = ticks.agg(F.max("ts")).scalar()
    cents = F.round(F.col("value") * 100).cast("bigint")
    recent = F.when(F.col("ts") > now - F.expr("interval 1 day"), cents)
    snap = tk.snapshot(
        ticks, HORIZONS, {"_cents": F.sum(cents), "_recent": F.sum(recent)}, key="key"
    )
    key = F.col("key")
    scale = F.power(F.lit(10.0), (key % 6 + 1).cast("double"))
    sized = snap.withColumn("market_cap", F.col("_cents").cast("double") * scale)
    # rank 1.. by size, ties by key: positions of the whole ordering
    ranked = with_position(sized, [F.desc("market_cap"), F.col("key")])
    pct = {h: F.col(f"change_pct_{h}") for h in HORIZONS}
    cap_change = F.col("market_cap") * pct["24h"] / F.lit(100.0)
    # the dates of the extremes are not in the ticks' aggregates: the first tick stands in
    made: dict[str, Column] = {
        "id": key.cast("string"),
        "symbol": F.lower(F.concat(F.lit("s"), key.cast("string"))),
        "name": F.concat(F.lit("Asset "), key.cast("string")),
        # no quote after two days without a tick, no rank without a trade in the last day
        "current_price": F.when(
            F.col("last_at") > now - F.expr("interval 2 days"), F.col("current_price")
        ),
        "market_cap_rank": F.when(F.col("_recent").isNotNull(), F.col("_idx") + 1),
        "fully_diluted_valuation": F.col("market_cap") * 2,
        "total_volume": F.col("_recent").cast("double") * scale,
        "price_change_24h": F.col("change_24h"),
        "price_change_percentage_24h": pct["24h"],
        "market_cap_change_24h": cap_change,
        "market_cap_change_percentage_24h": pct["24h"],
        "circulating_supply": F.col("ticks").cast("double"),
        "total_supply": F.col("ticks").cast("double") * 2,
        "max_supply": F.when(key % 5 != 0, (F.col("ticks") + key % 40).cast("double")),
        "ath_change_percentage": F.col("ath_change_pct"),
        "ath_date": F.date_format("first_at", _ISO),
        "atl_change_percentage": F.col("atl_change_pct"),
        "atl_date": F.date_format("first_at", _ISO),
        "last_updated": F.date_format("last_at", _ISO),
    }
    made |= {
        f"price_change_percentage_{h}_in_currency": pct[h] for h in ("1h", "7d", "14d", "30d")
    }
    columns = [made.get(c, F.col(c)).alias(c) for c in ASSET_COLUMNS]
    return ranked.select(*columns, now.alias("ingested_at"))


def _newest_tick(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "events").agg(F.max("ts")).scalar()


def _daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns(
        {
            "day": F.col("o_orderdate").cast("date"),
            "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
        }
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover per order priority and day: a daily series over all days of the index."""
    daily = _daily_orders(spark, sf_dir).groupBy(F.col("o_orderpriority").alias("id"), "day")
    return daily.agg((F.sum("cents") / F.lit(100.0)).alias("close"))


def raw_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.sum(F.col("cents") % 101) % 101).cast("bigint")
    daily = _daily_orders(spark, sf_dir).groupBy("day").agg(value.alias("value"))
    return daily.select(
        "value",
        banded(F.col("value"), SENTIMENT_LABELS).alias("value_classification"),
        F.col("day").alias("timestamp_date"),
        _newest_tick(spark, sf_dir).alias("ingested_at"),
    )


def raw_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.col("cents").cast("double")

    def sum_of(column: str, text: str) -> Column:
        return F.sum(F.when(F.col(column) == text, cents).otherwise(F.lit(0.0)))

    daily = (
        _daily_orders(spark, sf_dir)
        .groupBy("day")
        .agg(
            F.sum(cents).alias("total_market_cap_usd"),
            sum_of("o_orderstatus", "F").alias("total_volume_usd"),
            sum_of("o_orderpriority", "1-URGENT").alias("_first"),
            sum_of("o_orderpriority", "2-HIGH").alias("_second"),
            F.count_distinct("o_custkey").alias("active_cryptocurrencies"),
            F.count("*").alias("markets"),
            sum_of("o_orderpriority", "4-NOT SPECIFIED").alias("_up"),
            sum_of("o_orderpriority", "5-LOW").alias("_down"),
        )
    )
    whole = F.col("total_market_cap_usd")
    change = F.col("_up") / F.nullif("_down", F.lit(0.0))
    return daily.select(
        "total_market_cap_usd",
        "total_volume_usd",
        share_pct(F.col("_first"), whole).alias("btc_dominance"),
        share_pct(F.col("_second"), whole).alias("eth_dominance"),
        "active_cryptocurrencies",
        "markets",
        F.coalesce(change, F.lit(0.0)).alias("market_cap_change_24h_pct"),
        day_text(F.col("day")).alias("snapshot_date"),
        _newest_tick(spark, sf_dir).alias("ingested_at"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    nations = F.broadcast(table(spark, sf_dir, "nation"))  # fixed 25 rows
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").cast("string").alias("coin_id"),
        F.col("c_mktsegment").alias("category"),
        F.col("n_name").alias("subcategory"),
    )


def raw_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = _newest_tick(spark, sf_dir)
    recent = table(spark, sf_dir, "events").filter(F.col("ts") > now - F.expr("interval 1 day"))
    scored = recent.groupBy("user_id").agg(F.count("*").alias("score"))
    key = F.col("user_id")
    return scored.select(
        key.cast("string").alias("coin_id"),
        F.concat(F.lit("Asset "), key.cast("string")).alias("name"),
        F.lower(F.concat(F.lit("s"), key.cast("string"))).alias("symbol"),
        F.when(F.col("score") > 1, key + 1).alias("market_cap_rank"),
        "score",
        day_text(now).alias("snapshot_date"),
        now.alias("ingested_at"),
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_assets": raw_assets,
    "raw_sentiment": raw_sentiment,
    "raw_global": raw_global,
    "raw_trending": raw_trending,
    "raw_categories": raw_categories,
}


class Market:
    """Raw tables of one data folder, and the tables built from them.

    ``market["name"]`` builds a staged table or mart from the raw tables as a
    lazy plan; ``stored("name")`` materialises it once, as the reports and
    checks of a finished run find it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._root = fresh_path(spark, "tables")
        self._stored: dict[str, DataFrame] = {}
        self._storing = threading.RLock()
        # the as-of time of the run: one value, read once
        newest = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
        self.now = instant(newest)

    def __getitem__(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return self.stored(name)
        if name in STAGED:
            return STAGED[name](self, self.now)
        return MARTS[name](self, self.now)

    def store(self, *names: str) -> None:
        """Materialise the tables that are not yet, each layer side by side."""
        missing = set(names) - set(self._stored)
        if not missing:
            return
        with self._storing:
            # staged tables and marts are built while several writes run, so
            # what they read is landed before
            wanted = missing if missing <= set(RAW_TABLES) else {*missing, *RAW_TABLES}
            for layer in (RAW_TABLES, STAGED, MARTS):
                builds = {
                    name: (lambda name=name: self._build(name))
                    for name in layer
                    if name in wanted and name not in self._stored
                }
                if builds:
                    self._stored |= replace_all(builds, self._root)

    def _build(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return RAW_TABLES[name](self.spark, self.sf_dir)
        return self[name]

    def stored(self, name: str) -> DataFrame:
        self.store(name)
        return self._stored[name]

    def ticks(self) -> DataFrame:
        return price_ticks(self.spark, self.sf_dir)


_markets: dict[tuple[str, str], Market] = {}
_lock = threading.Lock()


def market(spark: SparkSession, sf_dir: str) -> Market:
    """The market of a data folder, shared by all queries of a session.

    Its tables are derived once: a folder that changes meanwhile is not seen.
    """
    key = (spark.sparkContext.applicationId, str(sf_dir))
    with _lock:
        if key not in _markets:
            _markets[key] = Market(spark, str(sf_dir))
        return _markets[key]
