"""Price ticks to snapshots and per-asset daily series.

Ticks are first reduced to one row per asset and day with partial aggregates,
so an asset with a third of all ticks is spread over the map tasks and reaches
its window as one row per day. The last of several ticks at one time is the one
with the largest value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exact import exact_total
from tidemark.functions.ratios import change_pct


def _rank_of(value: Column) -> Column:
    """A whole number that orders doubles as they order themselves: NULL least, NaN most.

    Built as the bits of a double are, from exponent and mantissa, so that distinct
    values get distinct numbers (but for those within 1e-300 of 0).
    """
    size = F.abs(value)
    power = F.floor(F.log2(size))
    mantissa = size * F.pow(F.lit(2.0), -power)
    low = mantissa < 1  # the logarithm was rounded up to a whole number
    power, mantissa = power - low.cast("int"), F.when(low, mantissa * 2).otherwise(mantissa)
    bits = (power + 1023) * F.lit(2**52) + ((mantissa - 1) * F.lit(2.0**52)).cast("bigint")
    rank = F.when(size < 1e-300, F.lit(0)).otherwise(F.when(value < 0, -bits).otherwise(bits))
    return (
        F.when(value.isNull(), F.lit(-(2**62) * 2 + 1))
        .when(size < float("inf"), rank)
        .when(value < 0, F.lit(-(2**62) * 2 + 2))
        .otherwise(F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(F.lit(2**63 - 2)))
        .cast("decimal(20,0)")
    )


def tick_order(time: str, value: str) -> Column:
    """Orders ticks by time, and ticks at one time by value, in one number of fixed width.

    As the order of ``max_by`` it keeps the aggregation a hash aggregation; a pair of
    columns there would have every task sort its ticks first.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(18,0)")
    scaled = micros * F.lit(str(2**64)).cast("decimal(20,0)")
    return (scaled + _rank_of(F.col(value).cast("double"))).cast("decimal(38,0)")


def snapshot(
    ticks: DataFrame,
    horizons: Mapping[str, str],
    extra: Mapping[str, Column] | None = None,
    key: str = "id",
    time: str = "ts",
    value: str = "value",
    now: Column | None = None,
) -> DataFrame:
    """Last price, day range and volume, all-time marks and changes per horizon.

    ``horizons`` maps a suffix to an interval back from ``now``, by default the
    newest tick of the table; the reference price is the last one at or before that
    time. All aggregates keep fixed-width state, so ticks are combined by hash on
    the map side and never sorted.
    """
    if now is None:
        now = ticks.agg(F.max(time)).scalar()
    at, price, order = F.col(time), F.col(value), F.col("_order")
    last_day = at > now - F.expr("interval 1 day")
    past = {
        h: F.max_by(price, F.when(at <= now - F.expr(f"interval {span}"), order))
        for h, span in horizons.items()
    }
    grouped = ticks.withColumn("_order", tick_order(time, value)).groupBy(key).agg(
        F.max_by(price, order).alias("current_price"),
        exact_total(F.when(last_day, price)).alias("total_volume"),
        F.max(F.when(last_day, price)).alias("high_24h"),
        F.min(F.when(last_day, price)).alias("low_24h"),
        F.max(price).alias("ath"),
        F.min(price).alias("atl"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.count("*").alias("ticks"),
        *[c.alias(f"_past_{h}") for h, c in past.items()],
        *[c.alias(n) for n, c in (extra or {}).items()],
    )
    current = F.col("current_price")
    return grouped.withColumns(
        {f"change_pct_{h}": change_pct(current, F.col(f"_past_{h}")) for h in horizons}
        | {f"change_{h}": current - F.col(f"_past_{h}") for h in horizons}
        | {
            "ath_change_pct": change_pct(current, F.col("ath")),
            "atl_change_pct": change_pct(current, F.col("atl")),
        }
    ).drop(*[f"_past_{h}" for h in horizons])


def daily_prices(
    ticks: DataFrame, key: str = "id", time: str = "ts", value: str = "value"
) -> DataFrame:
    """Closing price and traded volume per asset and day."""
    return ticks.groupBy(key, F.col(time).cast("date").alias("day")).agg(
        F.max_by(value, tick_order(time, value)).alias("close"),
        exact_total(value).alias("volume"),
    )


def _series(key: str) -> Window:
    return Window.partitionBy(key).orderBy("day")


def daily_changes(daily: DataFrame, key: str = "id") -> DataFrame:
    previous = F.lag("close").over(_series(key))
    return daily.withColumn("change_pct", change_pct(F.col("close"), previous))


def rolling_volatility(
    daily: DataFrame, windows: tuple[int, ...] = (7, 30, 90), key: str = "id", digits: int = 4
) -> DataFrame:
    """Sample deviation of the daily change over the last 7, 30 and 90 rows."""
    changes = daily_changes(daily, key)
    frame = _series(key)
    return changes.withColumns(
        {
            f"volatility_{n}d": F.round(
                F.stddev_samp("change_pct").over(frame.rowsBetween(1 - n, 0)), digits
            )
            for n in windows
        }
    )


def sma_rsi(
    daily: DataFrame,
    short: int = 7,
    long: int = 21,
    rsi: int = 14,
    key: str = "id",
    digits: int = 4,
) -> DataFrame:
    """Simple means and the plain-average relative strength index of the close.

    No loss in the window gives 100, no move at all 50.
    """
    frame = _series(key)
    move = F.col("close") - F.lag("close").over(frame)
    moved = daily.withColumn("_move", move)
    recent = frame.rowsBetween(1 - rsi, 0)
    gain = F.avg(F.greatest("_move", F.lit(0.0))).over(recent)
    loss = F.avg(F.greatest(-F.col("_move"), F.lit(0.0))).over(recent)
    out = moved.withColumns(
        {
            f"sma_{short}": F.round(F.avg("close").over(frame.rowsBetween(1 - short, 0)), digits),
            f"sma_{long}": F.round(F.avg("close").over(frame.rowsBetween(1 - long, 0)), digits),
            "_gain": F.when(F.col("_move").isNotNull(), gain),
            "_loss": F.when(F.col("_move").isNotNull(), loss),
        }
    )
    strength = F.lit(100.0) * F.col("_gain") / F.nullif(
        F.col("_gain") + F.col("_loss"), F.lit(0.0)
    )
    level = F.when(F.col("_gain").isNotNull(), F.coalesce(strength, F.lit(50.0)))
    return out.withColumn("rsi", F.round(level, 2)).drop("_move", "_gain", "_loss")


def zscore(df: DataFrame, column: str, name: str, digits: int = 4) -> DataFrame:
    """Distance from the column mean in sample deviations; NULL if there is none."""
    stats = df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("dev")).alias("s")
    ).scalar()
    score = (F.col(column) - stats["mean"]) / F.nullif(stats["dev"], F.lit(0.0))
    return df.withColumn(name, F.round(score, digits))


def correlation(x: str, y: str) -> Column:
    """Pearson correlation of two columns over the rows where both are present.

    NULL, not an error, where a side does not vary.
    """
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return F.expr(
        f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) {both} * stddev_pop({y}) {both}, 0D)"
    )


def correlation_matrix(
    daily: DataFrame, leaders: DataFrame, size: int = 20, key: str = "id", digits: int = 6
) -> DataFrame:
    """Pairwise correlation of the daily closes of the leading assets.

    ``leaders`` has the columns (id, position); the first ``size`` by position and id
    take part, whatever positions are missing or tied, and an asset listed twice takes
    part once. The closes of one day become one wide row, so a pair is an aggregate
    over wide rows and the table is never joined with itself.
    """
    # at most ``size`` rows, numbered anew as positions may tie
    first = (
        leaders.filter(F.col("position").isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min("position").alias("position"))
        .orderBy("position", key)
        .limit(size)
    )
    place = F.row_number().over(Window.orderBy("position", key))
    chosen = F.broadcast(first.withColumn("position", place))
    wide = (
        daily.join(chosen, key)
        .groupBy("day")
        .pivot("position", list(range(1, size + 1)))
        .agg(F.first("close"))
    )
    places = range(1, size + 1)
    # each day once per asset: (a, its close, all closes), not once per pair
    sides = ", ".join(f"{p}, `{p}`" for p in places)
    per_asset = wide.selectExpr("*", f"stack({size}, {sides}) AS (a, x)").groupBy("a")
    rows = per_asset.agg(*[correlation("x", f"`{p}`").alias(f"r{p}") for p in places])
    cells = ", ".join(f"{p}, r{p}" for p in places)
    long = rows.selectExpr("a", f"stack({size}, {cells}) AS (b, r)")
    left = chosen.select(F.col(key).alias("asset_a"), F.col("position").alias("a"))
    right = chosen.select(F.col(key).alias("asset_b"), F.col("position").alias("b"))
    return (
        long.filter(F.col("a") < F.col("b"))
        .join(F.broadcast(left), "a")
        .join(F.broadcast(right), "b")
        .select("asset_a", "asset_b", F.round("r", digits).alias("correlation"))
    )
