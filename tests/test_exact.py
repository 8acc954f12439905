"""Sums and means that do not depend on the order of adding."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.exact import ExactSum, exact_mean, exact_total
from tidemark.operators.shares import group_share, share_of_total
from tidemark.plans import marts, reports
from tests.helpers import rows

SCHEMA = "g string, x double"


def expected(values, digits):
    total = sum(Decimal(repr(v)) for v in values)
    step = Decimal(1).scaleb(-digits)
    # the quotient of integers decides, not a quotient rounded before
    n, scaled = len(values), total / step
    low = (abs(scaled) // n, abs(scaled) % n)
    up = low[0] + (2 * low[1] >= n)
    return float(total), float((up * step).copy_sign(total))


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(9)
    return {
        "tie up": [0.005, 0.015, 0.01, 0.05, -0.055],
        "tie": [705.58, 705.59],
        "negative tie": [-705.58, -705.59],
        "just below": [0.125] * 3 + [0.124999999999999],
        "thirds": [1.0, 0.0, 0.0],
        "cents": [round(rng.uniform(-900, 900), 2) for _ in range(501)],
        "any": [rng.gauss(0, 1) * 10 ** rng.randint(-6, 9) for _ in range(500)],
        "large": [1e17 + 2, -1e17, 3.25, 1e20, -1e20, 2.5e21, 0.5],
        "zero": [0.0, -0.0],
    }


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_against_decimals(spark, groups, digits):
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], SCHEMA)
    found = df.groupBy("g").agg(exact_total("x").alias("s"), exact_mean("x", digits).alias("m"))
    for g, s, m in rows(found):
        total, mean = expected(groups[g], digits)
        assert (s, m) == (pytest.approx(total, rel=1e-15, abs=1e-15), mean), g


def test_values_that_are_not_finite_and_none(spark):
    df = spark.createDataFrame(
        [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.5), ("null", None),
         ("some", None), ("some", 1.25)], SCHEMA,
    )
    found = df.groupBy("g").agg(exact_total("x").alias("s"), exact_mean("x", 1).alias("m"))
    got = {g: (s, m) for g, s, m in rows(found)}
    assert all(math.isnan(v) for v in got["nan"])
    assert got["inf"] == (math.inf, math.inf)
    assert got["null"] == (None, None)
    assert got["some"] == (1.25, 1.3)
    assert rows(df.limit(0).agg(exact_total("x"), exact_mean("x", 1))) == [(None, None)]


def test_states_merge(spark, groups):
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], SCHEMA)
    days = df.withColumn("day", F.pmod(F.xxhash64("x"), F.lit(5)))
    states = days.groupBy("g", "day").agg(*ExactSum.of("x").columns("x"))
    merged = states.groupBy("g").agg(
        ExactSum.merged("x").total().alias("s"), ExactSum.merged("x").mean(2).alias("m")
    )
    whole = df.groupBy("g").agg(exact_total("x").alias("s"), exact_mean("x", 2).alias("m"))
    assert rows(merged) == rows(whole)
    held = states.where("day = 1").select(ExactSum.held("x").mean(2))
    assert rows(held) == rows(days.where("day = 1").groupBy("g").agg(exact_mean("x", 2)).drop("g"))


def test_reports_do_not_depend_on_the_partitions(market):
    """The same bytes for rows dealt over 1, 7 and 64 partitions in another order."""
    seen: dict[str, list] = {}
    for parts in (1, 7, 64):

        def dealt(name, parts=parts):
            df = market.stored(name)
            return df.orderBy(F.xxhash64(F.lit(parts), *df.columns)).repartition(parts)

        assets, sentiment, momentum = (dealt(n) for n in ("assets", "sentiment", "momentum_signals"))
        found = {
            "categories": reports.category_comparison(
                momentum, dealt("volatility_analysis"), dealt("raw_categories")
            ),
            "subcategories": reports.subcategory_performance(assets, dealt("raw_categories")),
            "cohorts": reports.signal_cohorts(momentum),
            "breadth": marts.market_breadth(assets),
            "zones": marts.zone_statistics(sentiment),
            "trends": marts.trend_summary(sentiment),
            "tiers": marts.tier_summary(assets),
            "dominance": marts.market_dominance(assets, "2024-01-01"),
            "regime": marts.market_regime(assets, sentiment, dealt("global_metrics"), "2024-01-01"),
            "asset shares": share_of_total(assets, "total_volume_24h", "share", 4),
            "group shares": group_share(assets, ["price_tier"], "total_volume_24h", "share", 4),
        }
        for name, df in found.items():
            seen.setdefault(name, []).append(rows(df))
    for name, results in seen.items():
        assert results[0] == results[1] == results[2], name
        assert results[0], name
