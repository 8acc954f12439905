"""Inversions against the pairwise join and a plain double loop."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import inversions as inv
from tests.helpers import plan

SCHEMA = "d int, t string"


def by_hand(pairs):
    placed = [p for p in pairs if None not in p]
    return sum(a[0] < b[0] and a[1] > b[1] for a, b in itertools.permutations(placed, 2))


def found(df, size):
    return int(inv.inversion_count(df, "d", "t", size).first()["inversions"])


@given(st.lists(st.integers(0, 2**40), unique=True, max_size=60), st.integers(0, 10**6))
@settings(deadline=None)
def test_in_one_task(ranks, seed):
    rng = random.Random(seed)
    weights = [rng.choice([1, 2, 2**33]) for _ in ranks]
    expected = sum(
        weights[i] * weights[j]
        for i, j in itertools.combinations(range(len(ranks)), 2)
        if ranks[i] > ranks[j]
    )
    got = inv.inverted_weight(np.array(ranks, dtype=np.int64), np.array(weights, dtype=np.int64))
    assert got == expected


@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from("abcde"))),
        max_size=40,
    ),
    st.sampled_from([3, 10**6]),
)
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_ties_and_nulls(spark, pairs, size):
    assert found(spark.createDataFrame(pairs, SCHEMA), size) == by_hand(pairs)


@pytest.mark.parametrize("size", [700, 10**6])
def test_hot_keys_and_values(spark, size):
    rng = random.Random(2)
    pairs = [
        (7 if i % 3 == 0 else rng.randint(0, 300), "hot" if i % 4 == 0 else str(rng.randint(0, 99)))
        for i in range(3_000)
    ]
    assert found(spark.createDataFrame(pairs, SCHEMA), size) == by_hand(pairs)


def test_hundred_thousand_rows(spark):
    df = spark.range(100_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5_000)).cast("int").alias("d"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).alias("t"),
    )
    # plain count: sorted days per value, pair by pair of values
    days = df.groupBy("t").agg(F.sort_array(F.collect_list("d")).alias("days")).collect()
    held = [(r["t"], np.array(r["days"])) for r in days]
    expected = sum(
        int(np.searchsorted(a, b, side="left").sum())
        for (v, a), (w, b) in itertools.permutations(held, 2)
        if v > w
    )
    one = inv.inversion_count(df, "d", "t")
    many = inv.inversion_count(df, "d", "t", size=9_000)
    assert int(one.first()[0]) == int(many.first()[0]) == expected
    for df_ in (one, many):
        text = plan(df_)
        assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_empty_and_sorted(spark):
    assert found(spark.createDataFrame([], SCHEMA), 10) == 0
    ordered = spark.range(5_000).select(F.col("id").alias("d"), F.col("id").alias("t"))
    assert found(ordered, 600) == 0
    assert found(ordered.select("d", (-F.col("t")).alias("t")), 600) == 5_000 * 4_999 // 2
