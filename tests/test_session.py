"""Intermediate tables leave no shuffle files, and settings stay as they were."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark import session


def shuffled(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = disk.getAllBlocks()
    return sum(files.apply(i).name().startswith("shuffle_") for i in range(files.size()))


def grouped(spark, n):
    return spark.range(5_000).groupBy((F.col("id") % n).alias("k")).count()


def test_shuffle_files_go_with_the_write(spark):
    before = shuffled(spark)
    kept = grouped(spark, 7)
    kept.collect()
    assert shuffled(spark) > before
    before = shuffled(spark)
    table = session.materialised(grouped(spark, 11).join(grouped(spark, 11).drop("count").hint("shuffle_hash"), "k"))
    assert shuffled(spark) <= before
    assert table.count() == 11
    assert kept.count() == 7


def test_settings_stay(spark):
    own = spark.conf.get(session._CLEANUP)
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda n: session.materialised(grouped(spark, n)), range(3, 11)))
    assert [t.count() for t in tables] == list(range(3, 11))
    assert spark.conf.get(session._CLEANUP) == own
    with pytest.raises(Exception, match="lost"):
        session.materialised(spark.range(3).select(F.raise_error(F.lit("lost")).alias("x")))
    assert spark.conf.get(session._CLEANUP) == own
