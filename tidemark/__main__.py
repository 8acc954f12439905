"""``python -m tidemark``: rebuild all tables from landed files.

Also the application to hand to ``spark-submit``. The landing folder holds
``assets``, ``sentiment``, ``global``, ``trending`` and ``categories``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tidemark.functions.dates import instant
from tidemark.plans.refresh import refresh
from tidemark.session import get_spark
from tidemark.sources import readers
from tidemark.sources.published import Publisher


def main(argv: Sequence[str] | None = None) -> None:
    options = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    options.add_argument("--landing", required=True, help="folder with the landed responses")
    options.add_argument("--target", required=True, help="folder the tables are written to")
    options.add_argument("--as-of", help="UTC time of the run, now if left out")
    options.add_argument("--report-only", action="store_true", help="failed checks do not block")
    options.add_argument("--multiline", action="store_true", help="one pretty-printed file each")
    options.add_argument(
        "--by-name", action="store_true", help="publish the tables in the catalog, stored under the target"
    )
    chosen = options.parse_args(argv)

    spark = get_spark()
    as_of = instant(chosen.as_of)

    def read(name: str, reader) -> object:
        return reader(spark, f"{chosen.landing}/{name}", as_of, chosen.multiline)

    raw = {
        "raw_assets": read("assets", readers.read_assets),
        "raw_sentiment": read("sentiment", readers.read_sentiment),
        "raw_global": read("global", readers.read_global),
        "raw_trending": read("trending", readers.read_trending),
        "raw_categories": readers.read_categories(spark, f"{chosen.landing}/categories"),
    }
    publisher = Publisher(spark, chosen.target) if chosen.by_name else None
    refresh(raw, chosen.target, as_of, not chosen.report_only, publisher)


if __name__ == "__main__":
    main()
