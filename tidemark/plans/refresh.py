"""Build every table from the raw ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from tidemark.functions.dates import instant
from tidemark.operators.quality import require
from tidemark.plans import marts, staging
from tidemark.plans.checks import run_checks
from tidemark.sources.published import NAMESPACES, Publisher
from tidemark.sources.sinks import at_once, replace_table

RAW = ("raw_assets", "raw_sentiment", "raw_global", "raw_trending", "raw_categories")

Tables = Mapping[str, DataFrame]

# Each table as a function of the tables before it, in build order.
STAGED: dict[str, Callable[[Tables, Column], DataFrame]] = {
    "assets": lambda t, _: staging.enrich_assets(t["raw_assets"]),
    "sentiment": lambda t, _: staging.stage_sentiment(t["raw_sentiment"]),
    "global_metrics": lambda t, _: staging.stage_global(t["raw_global"]),
}
MARTS: dict[str, Callable[[Tables, Column], DataFrame]] = {
    "market_dominance": lambda t, day: marts.market_dominance(t["assets"], day),
    "volatility_analysis": lambda t, day: marts.volatility_analysis(t["assets"], day),
    "momentum_signals": lambda t, day: marts.momentum_signals(t["assets"], t["sentiment"], day),
    "top_performers": lambda t, day: marts.top_performers(t["assets"], day),
    "zone_impact": lambda t, day: marts.zone_impact(t["sentiment"], day),
    "market_regime": lambda t, day: marts.market_regime(
        t["assets"], t["sentiment"], t["global_metrics"], day
    ),
}


def refresh(
    raw: Tables,
    target: str,
    as_of: Column | str | None = None,
    blocking: bool = True,
    publisher: Publisher | None = None,
) -> dict[str, DataFrame]:
    """Replace all tables under ``target`` and return them as written.

    With ``blocking``, the checks of a layer must pass before the next layer is
    built. A failed run can be repeated: every table is a full replace. With a
    ``publisher`` the tables are replaced by name instead, each layer in its
    namespace, and a reader never finds one missing.
    """
    now = instant(as_of)
    tables: dict[str, DataFrame] = {}
    landed = {name: (lambda t, _, name=name: raw[name]) for name in RAW if name in raw}
    for namespace, layer in zip(NAMESPACES, (landed, STAGED, MARTS), strict=True):
        known = {**raw, **tables}

        def write(name: str, build, namespace=namespace, known=known) -> DataFrame:
            df = build(known, now)
            if publisher is not None:
                return publisher.publish(df, namespace, name)
            return replace_table(df, f"{target}/{name}")

        written = at_once(
            {n: (lambda n=n, build=build, write=write: write(n, build)) for n, build in layer.items()}
        )
        if blocking:
            require(run_checks(written, now))
        tables.update(written)
    return tables
