"""Headline queries, timed one by one: prints one JSON line.

Raw tables are landed first (timed as ``land_raw``), as an ingestion run would;
each query is then run to completion without collecting its rows.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.catalog import QUERIES
from tidemark.fixtures import RAW_TABLES, market
from tidemark.session import get_spark

HEADLINE = [
    "enriched_assets",
    "sentiment_daily",
    "global_metrics",
    "market_dominance",
    "volatility_analysis",
    "momentum_signals",
    "top_performers",
    "sentiment_zone_impact",
    "market_snapshot",
    "rolling_volatility",
    "sma_rsi",
    "correlation_matrix",
    "sentiment_price_corr",
    "zone_runs",
    "occurrence_in_zone",
    "moving_average",
    "rank_by_size",
    "join_tier_summary",
    "group_share",
    "order_inversions",
    "distinct_counts",
    "category_comparison",
    "sink_merge_latest",
    "dq_suite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "tidemark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        started = time.perf_counter()
        action()
        return round(time.perf_counter() - started, 3)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def land() -> None:
        market(spark, sf_dir).store(*RAW_TABLES)

    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    seconds = {"land_raw": timed(land), "market_regime": timed(lambda: run("market_regime"))}
    # the finished tables that the reports and checks read
    seconds["store_tables"] = timed(lambda: run("row_counts"))
    seconds |= {name: timed(lambda name=name: run(name)) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
