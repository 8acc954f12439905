from __future__ import annotations

import pytest

from tidemark.session import get_spark

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def market(spark):
    from tidemark.fixtures import market

    return market(spark, SF)


@pytest.fixture(scope="session")
def folder(spark):
    """A new path under the shared folder per call."""
    from tidemark.session import fresh_path

    return lambda label="test": fresh_path(spark, label)
