"""Small slices of a large table are few: each is a task that answers to the driver."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import rows, same
from tidemark.operators import ordering as o


def test_small_slices_do_not_grow_with_the_table(spark):
    sliced = o.slice_rows(spark.range(20_000), ["id"], 20)
    assert sliced.select("_slice").distinct().count() <= o.MOST_SMALL
    assert o._parts(54_000_000, 1_000) == 217
    assert o._parts(540_000_000, o.SLICE_ROWS) == 271


def test_occurrences_over_small_slices(spark):
    df = spark.range(3_000).withColumn("g", F.when(F.col("id") % 7 > 2, F.col("id") % 3))
    got = o.occurrence_in_group(df, "g", ["id"], "n", 5)
    place = F.row_number().over(Window.partitionBy("g").orderBy("id")).cast("long")
    assert same(got, df.withColumn("n", place))


def test_runs_over_small_slices(spark):
    df = spark.range(3_000).withColumn("g", F.floor(F.col("id") / 50) % 3)
    got = rows(o.group_runs(df, ["id"], "g", "a", "b", "n", 5), "a", "b", "n", "g")
    assert got == sorted(((i, i + 49, 50, i // 50 % 3) for i in range(0, 3_000, 50)), key=repr)
