"""Tables by name: replaced without a gap, read while they are."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tidemark import files
from tidemark.fixtures import RAW_TABLES
from tidemark.plans.refresh import MARTS, STAGED, refresh
from tidemark.sources.published import NAMESPACES, Publisher
from tests.helpers import rows


@pytest.fixture
def publisher(spark, folder):
    yield Publisher(spark, folder("published"))
    for namespace in NAMESPACES:
        for t in spark.catalog.listTables(namespace):
            if t.namespace == [namespace]:
                spark.sql(f"DROP VIEW {namespace}.`{t.name}`")


def test_tables_by_name(spark, publisher):
    publisher.publish(spark.range(5), "raw", "assets")
    publisher.publish(spark.table("raw.assets").where("id > 1"), "staging", "assets")
    assert spark.table("staging.assets").count() == 3
    assert spark.sql("select count(*) from raw.assets join staging.assets using (id)").first()[0] == 3
    assert set(publisher.tables()) == {"raw.assets", "staging.assets"}
    assert publisher.location("raw", "assets") is not None
    assert publisher.location("analytics", "assets") is None
    with pytest.raises(ValueError):
        publisher.publish(spark.range(1), "other", "x")


def test_replaced_by_itself_and_by_other_columns(spark, publisher):
    publisher.publish(spark.range(5), "raw", "t")
    publisher.publish(spark.table("raw.t").withColumn("b", F.col("id") * 2), "raw", "t")
    assert spark.table("raw.t").columns == ["id", "b"]
    publisher.publish(spark.table("raw.t").select("b"), "raw", "t")
    assert sorted(r[0] for r in spark.table("raw.t").collect()) == [0, 2, 4, 6, 8]


def test_a_failed_write_leaves_the_table(spark, publisher):
    publisher.publish(spark.range(3), "raw", "t")
    with pytest.raises(Exception, match="stop here"):
        publisher.publish(spark.range(9).select(F.raise_error(F.lit("stop here")).alias("id")), "raw", "t")
    assert spark.table("raw.t").count() == 3


def test_readers_see_the_old_table_or_the_new(spark, publisher):
    """A reader beside a writer never finds no table, and never rows of two versions."""
    publisher.publish(spark.range(100).select(F.lit(0).alias("v")), "raw", "t")
    opened = spark.table("raw.t")  # before any replacement
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(tuple(r["v"] for r in spark.table("raw.t").select("v").distinct().collect()))
            except Exception as failure:
                failures.append(failure)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 9):
        publisher.publish(spark.range(100).select(F.lit(v).alias("v")), "raw", "t")
        if v == 1:
            assert {r["v"] for r in opened.collect()} == {0}
    done.set()
    reader.join()
    assert not failures
    assert len(seen) > 2
    assert all(len(s) == 1 for s in seen)
    assert [s[0] for s in seen] == sorted(s[0] for s in seen)


def test_old_versions_go(spark, publisher):
    for v in range(5):
        publisher.publish(spark.range(v + 1), "analytics", "t")
    versions = files.names(spark, f"{publisher.root}/analytics/t")
    assert len(versions) == 2
    assert publisher.location("analytics", "t").rpartition("/")[2] in versions
    assert spark.table("analytics.t").count() == 5


def test_a_refresh_by_name(spark, publisher, market, folder):
    raw = {name: market[name] for name in RAW_TABLES}
    by_name = refresh(raw, folder("unused"), market.now, blocking=False, publisher=publisher)
    by_path = refresh(raw, folder("paths"), market.now, blocking=False)
    assert set(publisher.tables()) == (
        {f"raw.{n}" for n in RAW_TABLES}
        | {f"staging.{n}" for n in STAGED}
        | {f"analytics.{n}" for n in MARTS}
    )
    for name in ("raw_assets", "sentiment", "market_regime"):
        assert rows(by_name[name]) == rows(by_path[name])
    found = spark.sql(
        "select r.regime, count(*) from analytics.market_regime r cross join staging.assets group by 1"
    )
    assert found.count() == 1
