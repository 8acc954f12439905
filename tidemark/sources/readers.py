"""Landed API responses and seed files to raw tables.

Every reader has a fixed schema (no inference pass over the data) and stops on
a malformed document rather than dropping it. By default a file holds one
response per line, which Spark can split; ``multiline=True`` reads files that
hold one pretty-printed response each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import day_text, instant, utc_day
from tidemark.sources import schemas

AsOf = Column | dt.datetime | str | None


def _json(spark: SparkSession, path: str, schema: str, multiline: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("multiLine", multiline).json(path)


def _whole_number(text: Column) -> Column:
    """Integer from its JSON text, also when written as ``12.0`` or ``1.2e1``."""
    return text.cast("decimal(38,6)").cast("bigint")


def read_assets(
    spark: SparkSession, path: str, as_of: AsOf = None, multiline: bool = False
) -> DataFrame:
    """A JSON array of flat asset objects; fields a response lacks become NULL."""
    schema = ", ".join(
        f"{c} {'string' if t == 'bigint' else t}" for c, t in schemas.ASSET_COLUMNS.items()
    )
    df = _json(spark, path, schema, multiline)
    columns = [
        _whole_number(F.col(c)).alias(c) if t == "bigint" else F.col(c)
        for c, t in schemas.ASSET_COLUMNS.items()
    ]
    return df.select(*columns, instant(as_of).alias("ingested_at"))


def _required(df: DataFrame, name: str) -> Column:
    """The field; a response without it, such as an error, stops the run."""
    problem = F.raise_error(F.lit(f"response without '{name}'")).cast(df.schema[name].dataType)
    return F.when(F.col(name).isNull(), problem).otherwise(F.col(name))


def read_sentiment(
    spark: SparkSession, path: str, as_of: AsOf = None, multiline: bool = False
) -> DataFrame:
    """``{"data": [{value, value_classification, timestamp}]}``; numbers come as text."""
    df = _json(spark, path, schemas.SENTIMENT_DOCUMENT, multiline)
    return df.select(F.explode(_required(df, "data")).alias("d")).select(
        F.col("d.value").cast("bigint").alias("value"),
        F.col("d.value_classification").alias("value_classification"),
        utc_day(F.col("d.timestamp").cast("bigint")).alias("timestamp_date"),
        instant(as_of).alias("ingested_at"),
    )


def _entry(container: str, key: str) -> Column:
    """Map entry, 0 where the key is absent; NULL where the whole map is."""
    entries = F.col(container)
    return F.when(
        entries.isNotNull(), F.coalesce(F.try_element_at(entries, F.lit(key)), F.lit(0.0))
    )


def read_global(
    spark: SparkSession, path: str, as_of: AsOf = None, multiline: bool = False
) -> DataFrame:
    """Nested per-currency maps flattened to one row per response."""
    df = _json(spark, path, schemas.GLOBAL_DOCUMENT, multiline)
    df = df.select(_required(df, "data").alias("data")).select("data.*")
    stamp = instant(as_of)
    return df.select(
        _entry("total_market_cap", "usd").alias("total_market_cap_usd"),
        _entry("total_volume", "usd").alias("total_volume_usd"),
        _entry("market_cap_percentage", "btc").alias("btc_dominance"),
        _entry("market_cap_percentage", "eth").alias("eth_dominance"),
        F.coalesce(_whole_number(F.col("active_cryptocurrencies")), F.lit(0)).alias(
            "active_cryptocurrencies"
        ),
        F.coalesce(_whole_number(F.col("markets")), F.lit(0)).alias("markets"),
        F.coalesce("market_cap_change_percentage_24h_usd", F.lit(0.0)).alias(
            "market_cap_change_24h_pct"
        ),
        day_text(stamp).alias("snapshot_date"),
        stamp.alias("ingested_at"),
    )


def read_trending(
    spark: SparkSession, path: str, as_of: AsOf = None, multiline: bool = False
) -> DataFrame:
    """``coins[].item`` objects; absent text is empty, absent numbers are NULL."""
    df = _json(spark, path, schemas.TRENDING_DOCUMENT, multiline)
    item = "c.item"
    stamp = instant(as_of)
    return df.select(F.explode("coins").alias("c")).select(
        F.coalesce(f"{item}.id", F.lit("")).alias("coin_id"),
        F.coalesce(f"{item}.name", F.lit("")).alias("name"),
        F.coalesce(f"{item}.symbol", F.lit("")).alias("symbol"),
        _whole_number(F.col(f"{item}.market_cap_rank")).alias("market_cap_rank"),
        _whole_number(F.col(f"{item}.score")).alias("score"),
        day_text(stamp).alias("snapshot_date"),
        stamp.alias("ingested_at"),
    )


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with a header; a missing path or other header is an error."""
    return (
        spark.read.schema(schemas.CATEGORY_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
