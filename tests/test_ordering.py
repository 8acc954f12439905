"""The scalable forms against plain whole-table windows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import plan, rows, same
from tidemark.operators import ordering as o


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; a third share one value and one group; some values are NULL."""
    n = F.col("id")
    return (
        spark.range(20_000)
        .withColumn("g", F.when(n % 3 == 0, F.lit("hot")).otherwise((n % 11).cast("string")))
        .withColumn(
            "x",
            F.when(n % 3 == 0, 7.0)
            .when(n % 101 != 0, F.pmod(F.xxhash64("id"), F.lit(500)).cast("double")),
        )
    )


def test_position(skewed):
    order = [F.col("x").desc_nulls_last(), F.col("id")]
    got = o.with_position(skewed, order).select("id", F.col("_idx").cast("long"))
    naive = skewed.select("id", (F.row_number().over(Window.orderBy(*order)) - 1).alias("_idx"))
    assert same(got, naive.withColumn("_idx", F.col("_idx").cast("long")))


# one slice, and many
BOTH = pytest.mark.parametrize("size", [100_000, 2_000])


@BOTH
@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_ties_and_nulls(skewed, descending, size):
    order = F.col("x").desc_nulls_last() if descending else F.col("x").asc_nulls_last()
    got = o.competition_rank(skewed, "x", "r", descending, size)
    naive = skewed.withColumn("r", F.rank().over(Window.orderBy(order)).cast("long"))
    assert same(got, naive)


def test_trailing_across_many_blocks(skewed):
    order = [F.col("id")]
    columns = {
        "mean": lambda w: F.avg("x").over(w.rowsBetween(-13, 0)),
        "step": lambda w: F.col("x") - F.lag("x").over(w),
    }
    got = o.trailing(o.with_position(skewed, order), columns, 13, block=7)
    window = Window.orderBy(*order)
    naive = skewed.withColumns({n: build(window) for n, build in columns.items()})
    assert same(got.select(*naive.columns), naive)


def test_series_forms_agree(skewed):
    columns = {"mean": lambda w: F.avg("x").over(w.rowsBetween(-6, 0))}
    small = o.series_columns(skewed, ["id"], columns, 6)
    large = o.series_columns(skewed, ["id"], columns, 6, size=1_500)
    assert same(small, large)


@BOTH
def test_occurrence_in_hot_group(skewed, size):
    got = o.occurrence_in_group(skewed, "g", ["id"], "n", size)
    naive = skewed.withColumn(
        "n", F.row_number().over(Window.partitionBy("g").orderBy("id")).cast("long")
    )
    assert same(got, naive)


def test_running_total(skewed):
    got = o.running_total(o.with_position(skewed, [F.col("id")]), F.col("id") % 5, "s")
    naive = skewed.withColumn("s", F.sum(F.col("id") % 5).over(Window.orderBy("id")))
    assert same(got.select(*naive.columns), naive)


@BOTH
def test_earlier_max(skewed, size):
    keyed = skewed.withColumn("k", (F.col("id") / 10).cast("int"))
    got = o.earlier_max(keyed, "k", F.col("x"), "m", size)
    per = keyed.groupBy("k").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    assert same(got, per.withColumn("m", F.max("high").over(before)))


@pytest.mark.parametrize("size", [100, 1, 3])
def test_runs_by_hand(spark, size):
    df = spark.createDataFrame(list(enumerate("aabbbacc")), "t int, z string")
    runs = o.group_runs(df, ["t"], "z", "first", "last", "n", size)
    got = rows(runs, "z", "first", "last", "n")
    assert got == [("a", 0, 1, 2), ("a", 5, 5, 1), ("b", 2, 4, 3), ("c", 6, 7, 2)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=40))
def test_runs_and_ranks_on_any_series(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "t int, z int")
    expected = []
    for t, z in enumerate(values):
        if expected and expected[-1][0] == z:
            expected[-1][2], expected[-1][3] = t, expected[-1][3] + 1
        else:
            expected.append([z, t, t, 1])
    got = rows(o.group_runs(df, ["t"], "z", "a", "b", "n", 1), "z", "a", "b", "n")
    assert got == sorted(map(tuple, expected), key=repr)
    ranked = {r.t: r.r for r in o.competition_rank(df, "z", "r", True, 1).collect()}
    key = [-1 if z is None else z for z in values]
    assert ranked == {t: 1 + sum(k > key[t] for k in key) for t in range(len(key))}


def test_empty_input(spark):
    df = spark.createDataFrame([], "t int, z int")
    assert o.with_position(df, ["t"]).count() == 0
    lag = {"l": lambda w: F.lag("z").over(w)}
    for limit in (10, 1):
        assert o.competition_rank(df, "z", "r", True, limit).count() == 0
        assert o.occurrence_in_group(df, "z", ["t"], "n", limit).count() == 0
        assert o.group_runs(df, ["t"], "z", "a", "b", "n", limit).count() == 0
        assert o.series_columns(df, ["t"], lag, 1, limit).count() == 0


def test_no_whole_table_task(skewed):
    """Beyond one slice, windows over everything see one row per slice only."""
    counts = skewed.groupBy("x").agg(F.count("*").alias("n"))
    text = plan(o.ranks_by_value(counts, "x", "n", "r", size=100))
    before_single = text.split("Exchange SinglePartition")[1].lstrip(", ")
    assert "HashAggregate(keys=[_slice" in before_single.split("\n")[1]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rows_that_tie_on_the_order_still_split(spark):
    df = spark.range(8_000).withColumn("day", F.lit("2024-01-01"))
    sizes = o.slice_rows(df, ["day"], 2_500).groupBy("_slice").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4_000


def test_equal_rows_split_too(spark):
    df = spark.range(20_000).select(F.when(F.col("id") > 4_999, -1).otherwise(F.col("id")).alias("x"))
    sizes = o.slice_rows(df, ["x"], 5_001).groupBy("_slice").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 10_000


def test_slices_stay_small(spark):
    sliced = o.slice_rows(spark.range(10_000), ["id"], 1_000)
    assert sliced.groupBy("_slice").count().count() == 11


def test_ties_fall_alike_for_any_number_of_slices(spark):
    rows = [(i % 3, "ab"[i % 2], float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "day int, kind string, value double")

    def mean(window):
        return F.avg("value").over(window.rowsBetween(-3, 0))

    plain, sliced = (
        o.series_columns(df, ["day"], {"m": mean}, 3, bound) for bound in (1000, 7)
    )
    assert same(plain, sliced)
    plain, sliced = (
        o.occurrence_in_group(df, "kind", ["day"], "n", bound) for bound in (1000, 7)
    )
    assert same(plain, sliced)
    plain, sliced = (
        o.group_runs(df, ["day"], "kind", "first", "last", "length", bound)
        for bound in (1000, 7)
    )
    assert same(plain, sliced)


def test_null_is_no_place_in_an_order(spark):
    df = spark.createDataFrame([(None, 9), (1, 1), (2, 2)], "day int, at int")
    rows_ = o.earlier_max(df, "day", F.col("at"), "top").collect()
    assert {r["day"]: r["top"] for r in rows_} == {1: None, 2: 1}
